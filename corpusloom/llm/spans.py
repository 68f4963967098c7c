"""Places of regular expressions in texts, with DataFrame functions only.

Spark has the matches of a pattern (regexp_extract_all) and what stands between them (split), but not their places. Their
lengths give them: a match starts at the sum of all pieces and matches before it. Running sums and maxima go by blocks of
blocks, so that many matches in one text cost little more than their number.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_BLOCK, _TEXT_BLOCK = 64, 4096
SPAN = "struct<start:bigint,ord:int,kind:string,end:bigint,value:string>"


def matches(text: Column, pattern: str) -> Column:
    """Arrays of the matches and of the pieces around them, as a struct; null where nothing matches. Both are made in one
    expression each, so that the text is searched only where the pattern occurs."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    return F.when(text.rlike(pattern), F.struct(found.alias("m"), F.split(text, pattern, -1).alias("p")))


def _let(name: str, value: str, body: str) -> str:
    return f"transform(array({value}), {name} -> {body})[0]"


def running(values: str, merge: str, zero: str = "0L") -> str:
    """SQL of an array of bigint folded up to and with each element; merge is an expression of a and y.

    Blocks are folded first, then blocks of blocks; an element needs at most one block of each level.
    """
    fold = lambda part, start: f"aggregate({part}, {start}, (a, y) -> {merge})"
    blocks = lambda name: f"transform(sequence(0, (size({name}) - 1) div {_BLOCK}), b -> {fold(f'slice({name}, int(b * {_BLOCK} + 1), {_BLOCK})', zero)})"
    before = lambda name, up: f"transform({name}, (x, i) -> {fold(f'slice({name}, int(i div {_BLOCK}) * {_BLOCK} + 1, i % {_BLOCK})', f'{up}[int(i div {_BLOCK})]')})"
    result = f"transform(v0, (x, i) -> {fold(f'slice(v0, int(i div {_BLOCK}) * {_BLOCK} + 1, i % {_BLOCK} + 1)', f'p1[int(i div {_BLOCK})]')})"
    top = f"transform(v2, (x, i) -> {fold('slice(v2, 1, i)', zero)})"
    return _let("v0", values, _let("v1", blocks("v0"), _let("v2", blocks("v1"), _let("p2", top, _let("p1", before("v1", "p2"), result)))))


def spans(found: str, kind: str, order: int) -> Column:
    """array<SPAN> of the column `found` made by matches(); starts and ends in code points, end exclusive."""
    steps = f"transform({found}.m, (v, i) -> cast(char_length({found}.p[i]) + if(i = 0, 0, char_length({found}.m[i - 1])) as bigint))"
    return F.expr(f"""
        coalesce(transform(zip_with({found}.m, {running(steps, "a + y")}, (v, s) -> struct(v, s)), x ->
            struct(x.s as start, {order} as ord, '{kind}' as kind, x.s + char_length(x.v) as end, x.v as value)),
            cast(array() as array<{SPAN}>))""")


def free_of(words: str, base: str, kind: str = SPAN) -> str:
    """SQL of the words, spans of the type `kind` that do not overlap each other, that overlap no span of base.

    All are sorted, a word by its last character; it is free if no base span that starts before that reaches beyond its start.
    """
    events = f"""array_sort(concat(transform({base}, e -> struct(2 * e.start as at, e.end as reach, cast(null as {kind}) as w)),
        transform({words}, w -> struct(2 * w.end - 1 as at, -1L as reach, cast(w as {kind}) as w))))"""
    reach = running("transform(sorted, e -> e.reach)", "greatest(a, y)", "-1L")
    free = f"filter(zip_with(sorted, {reach}, (e, m) -> if(m <= e.w.start, e.w, cast(null as {kind}))), w -> w IS NOT NULL)"
    return _let("sorted", events, free)


def replaced(text: str, marks: str, word: str) -> Column:
    """The text with its spans (sorted by start) replaced by `word`, SQL over a span x. Of overlapping spans the first is
    replaced, and what the others have beyond it goes with it."""
    piece = lambda a, b: f"if({b} > {a}, substring(array_join(slice(parts, int({a} div {_TEXT_BLOCK} + 1), int(({b} - 1) div {_TEXT_BLOCK} - {a} div {_TEXT_BLOCK} + 1)), ''), int({a} % {_TEXT_BLOCK} + 1), int({b} - {a})), '')"
    done = running(f"transform({marks}, y -> y.end)", "greatest(a, y)")
    before = "if(i = 0, 0L, done[i - 1])"
    each = f"transform({marks}, (x, i) -> if(x.start < {before}, '', concat({piece(before, 'x.start')}, {word})))"
    tail = piece("done[size(done) - 1]", f"char_length({text})")
    return F.expr(_let("parts", f"regexp_extract_all({text}, '(?s).{{1,{_TEXT_BLOCK}}}', 0)", _let("done", done, f"concat(array_join({each}, ''), {tail})")))


def listed(spans_col: str) -> Column:
    """kind:start:end of the sorted spans, joined by commas."""
    return F.expr(f"array_join(transform({spans_col}, x -> concat(x.kind, ':', x.start, ':', x.end)), ',')")


def found_sql(kind: str, order: int, pattern: str) -> str:
    """DuckDB SQL of the matches of a pattern in the table d (rid, t): rid, ord, kind, start, stop, v. Starts are summed up from
    the pieces and matches before, as above."""
    quoted = pattern.replace("'", "''")
    rows = f"SELECT rid, unnest(m) AS v, unnest(p[1:len(m)]) AS p, unnest(range(len(m))) AS i FROM (SELECT rid, regexp_extract_all(t, '{quoted}') AS m, string_split_regex(t, '{quoted}') AS p FROM d)"
    steps = f"SELECT rid, v, i, length(p) + coalesce(lag(length(v)) OVER (PARTITION BY rid ORDER BY i), 0) AS step FROM ({rows})"
    starts = f"SELECT rid, v, (sum(step) OVER (PARTITION BY rid ORDER BY i))::BIGINT AS start FROM ({steps})"
    return f"SELECT rid, {order} AS ord, '{kind}' AS kind, start, start + length(v) AS stop, v FROM ({starts})"


def listed_sql(where: str = "true") -> str:
    """kind:start:end of a group's rows, as listed()."""
    return f"coalesce(string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY start, ord) FILTER (WHERE {where}), '')"
