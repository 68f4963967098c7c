"""Operator 4, n-gram Jaccard join with adaptive multi-match prefixes.

Two sets are linked if 100 * intersection >= percent * union. Sets are sorted by a hash order; two linked sets share at
least l tokens in their prefixes of n - needed + l tokens, where needed = ceil(percent * n / 100). So:

1. Equal sets are one class; only classes are compared.
2. A class's prefix is lengthened by l (see shared_needed). Tokens of prefixes that one class alone has can't match, so a class
   with fewer than l other tokens has no partner and is done: most documents leave here.
3. Of the l shared tokens, the first k by (frequency, token) lie among the prefix's p - l + k rarest, which are kept. k is
   chosen for each class by the estimated cost of its candidates: each further match needs one more, more frequent token, and
   leaves fewer candidates to verify. Pairs must share the smaller k of both before they are verified, wherever they meet.
4. A class goes to its home, the most frequent of these tokens. A small home compares all its classes; a large one, in this
   round, all with a block of pivots. A task tells only the links that join its components.
5. Then classes go to large homes again and, for tokens whose classes are of several components and homes, to the HOMES most
   frequent of these. Of each token, classes outside its largest component are compared with all of other components, in
   blocks: a group of near copies costs about its size, not its square.
6. What is left are pairs that share tokens, but neither a home nor a component. Tokens with more than PAIRS of them are
   compared as in 5; of the others, classes outside the largest component are joined to the others.

No step caps a bucket or drops a pair; whole sets are compared by 64-bit hashes of their shingles. Joins by token and by
component deal the rows of hot ones to many tasks.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.components import components
from corpusloom.llm.shared import apart, caches, chunks, claim, cut, matched, restored, small, spent
from corpusloom.shipping import ship

WORDS, PERCENT = 5, 80
#: Prefixes are lengthened by at least so many tokens (or one in SIXTEENTH of what is needed).
LENGTHEN, SIXTEENTH = 32, 16
#: Most matches that a class may require of its candidates before they are verified.
MATCHES = 3
#: Members and tokens of a block.
BLOCK_ROWS, BLOCK_TOKENS = 512, 300_000
#: Homes of a class in the second round, and most pairs of a token that are joined and not compared in blocks.
HOMES, PAIRS = 4, 250_000
_CACHE = 80_000
_U = np.uint64


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


class _Words(dict):
    """64-bit hashes of words; emptied when full."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= _CACHE:
            self.clear()
        value = self[word] = xxhash.xxh64_intdigest(word)
        return value


_words = _Words()
caches["ngram"] = _words.clear


def shingle_set(text: str | None, words: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of a text's word n-grams; of the whole sequence if it has fewer words; empty without."""
    parts = (text or "").encode("utf-8", "surrogatepass").lower().split()
    hashes = np.fromiter(map(_words.__getitem__, parts), _U, len(parts))
    n = min(words, len(parts))
    if not n:
        return hashes
    out = np.full(len(parts) - n + 1, n, _U)
    for k in range(n):
        out = _mix(out * _U(0x9E3779B97F4A7C15) + hashes[k : len(parts) - n + 1 + k])
    return np.unique(out)


def _needed(n: int, percent: int) -> int:
    """Least intersection of a set of n tokens with a linked one."""
    return -(-percent * n // 100)


def shared_needed(n: int, percent: int) -> int:
    """l: tokens that linked sets share in their prefixes, by set size. It never grows faster than what is needed, so that linked
    sets share the larger l of both."""
    return min(_needed(n, percent), max(LENGTHEN, -(-_needed(n, percent) // SIXTEENTH)))


def _sql_needed(n: str, percent: int) -> str:
    return f"(({percent} * ({n}) + 99) div 100)"


def _sql_shared(n: str, percent: int) -> str:
    needed = _sql_needed(n, percent)
    return f"least({needed}, greatest({LENGTHEN}, ({needed} + {SIXTEENTH - 1}) div {SIXTEENTH}))"


def _prefixes(words: int, percent: int):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        claim("ngram")
        for batch in chunks(batches, "text"):
            sizes, keys, prefixes = [], [], []
            for text in batch.column("text").to_pylist():
                tokens = shingle_set(text, words)
                n = len(tokens)
                sizes.append(n)
                keys.append(hashlib.blake2b(tokens.tobytes(), digest_size=16).digest())
                prefixes.append(tokens[: n - _needed(n, percent) + shared_needed(n, percent)].view(np.int64))
            arrays = [batch.column("doc_id").cast(pa.int64()), batch.column("text_hash"), pa.array(sizes, pa.int64()), pa.array(keys, pa.binary()), pa.array(prefixes, pa.list_(pa.int64()))]
            yield pa.record_batch(arrays, names=["doc_id", "text_hash", "n", "key", "prefix"])

    return rows


def _sets(words: int):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        claim("ngram")
        for batch in chunks(batches, "text"):
            tokens = [shingle_set(t, words).tobytes() for t in batch.column("text").to_pylist()]
            yield pa.record_batch([batch.column("node"), pa.array(tokens, pa.binary())], names=["node", "tokens"])

    return rows


def common_counts(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """Sizes of all intersections of two lists of sets: 0/1 matrices of the tokens that both sides have, multiplied in slabs."""
    counts = np.zeros((len(left), len(right)), np.float32)
    token = np.concatenate([*left, *right])
    row = np.repeat(np.arange(len(left) + len(right)), [len(x) for x in (*left, *right)])
    order = np.argsort(token, kind="stable")
    token, row = token[order], row[order]
    group = np.cumsum(np.concatenate([[0], token[1:] != token[:-1]]))
    on_left = row < len(left)
    size = group[-1] + 1 if len(group) else 0
    both = (np.bincount(group[on_left], minlength=size) > 0) & (np.bincount(group[~on_left], minlength=size) > 0)
    place = np.cumsum(both) - 1
    use = both[group]
    column, row, on_left = place[group[use]], row[use], on_left[use]
    for start in range(0, int(both.sum()), 2048):
        low, high = np.searchsorted(column, [start, start + 2048])
        a, b = np.zeros((len(left), 2048), np.float32), np.zeros((len(right), 2048), np.float32)
        here, r, s = column[low:high] - start, row[low:high], on_left[low:high]
        a[r[s], here[s]] = 1
        b[r[~s] - len(left), here[~s]] = 1
        counts += a @ b.T
    return counts


def _stars(linked: np.ndarray) -> list[tuple[int, int]]:
    """(first, member) of each component of a symmetric 0/1 matrix, by breadth-first search over its rows."""
    fresh, out = np.ones(len(linked), bool), []
    for first in range(len(linked)):
        if not fresh[first]:
            continue
        fresh[first], front = False, np.array([first])
        while len(front):
            front = np.flatnonzero(linked[front].any(axis=0) & fresh)
            fresh[front] = False
            out += [(first, k) for k in front.tolist()]
    return out


def linked_in_task(rows: list[tuple], percent: int) -> list[tuple[int, int]]:
    """The components that links between the left and the right rows make: pairs of a first node and another.

    rows are (node, k, kept, component, tokens, left, right). Pairs of different components that share the smaller k of both
    among their kept tokens are verified.
    """
    sides = [[r for r in rows if r[at]] for at in (5, 6)]
    if not all(sides):
        return []
    kept = [[np.unique(np.asarray(r[2], np.int64)).view(_U) for r in side] for side in sides]
    k, component = ([np.array([r[at] for r in side], np.int64) for side in sides] for at in (1, 3))
    asked = (common_counts(*kept) >= np.minimum.outer(*k)) & np.not_equal.outer(*component)
    first, second = np.flatnonzero(asked.any(axis=1)), np.flatnonzero(asked.any(axis=0))
    if not len(first):
        return []
    chosen = [[side[x] for x in at.tolist()] for side, at in zip(sides, (first, second), strict=True)]
    tokens = [[np.frombuffer(r[4], _U) for r in side] for side in chosen]
    both, sizes = common_counts(*tokens), [np.array([len(t) for t in side], np.float64) for side in tokens]
    linked = asked[np.ix_(first, second)] & (100.0 * both >= percent * (np.add.outer(*sizes) - both))
    nodes, place = np.unique([r[0] for side in chosen for r in side], return_inverse=True)
    joined = np.zeros((len(nodes), len(nodes)), bool)
    joined[np.ix_(place[: len(first)], place[len(first) :])] = linked
    return [(int(nodes[x]), int(nodes[y])) for x, y in _stars(joined | joined.T)]


def _task_links(percent: int):
    names = ("home", "i", "j", "node", "k", "kept", "component", "tokens", "l", "r")

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows of one task (home, i, j) stand together; each is done when the next begins."""
        claim("ngram")
        key, held, out = None, [], []
        for batch in batches:
            for home, i, j, *row in zip(*(batch.column(c).to_pylist() for c in names), strict=True):
                if (home, i, j) != key:
                    out += linked_in_task(held, percent)
                    key, held = (home, i, j), []
                held.append(tuple(row))
            if len(out) > 10_000:
                yield _pairs(out)
                out = []
        out += linked_in_task(held, percent)
        yield _pairs(out)

    return rows


def _pairs(pairs: list[tuple[int, int]]) -> pa.RecordBatch:
    return pa.record_batch([pa.array([p[k] for p in pairs], pa.int64()) for k in (0, 1)], names=["a", "b"])


def _verified(percent: int):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for a, b, x, y in zip(*(batch.column(c).to_pylist() for c in ("a", "b", "x", "y")), strict=True):
                x, y = np.frombuffer(x, _U), np.frombuffer(y, _U)
                both = len(np.intersect1d(x, y, assume_unique=True))
                if 100 * both >= percent * (len(x) + len(y) - both):
                    out.append((a, b))
            yield _pairs(out)

    return rows


def _identity(docs: DataFrame, id_col: str, text_col: str) -> list[Column]:
    return [F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(id_col, text_col).alias("text_hash"), F.col(text_col).alias("text")]


def _kept_prefixes(prefixes: DataFrame, percent: int) -> DataFrame:
    """node, n, k and tokens (array of structs df, token: the rarest of the prefix that others have too) of live classes,
    written. prefixes has node, n and prefix. The frequent tokens are written first, so that the shuffle that counted them is
    gone when postings are shuffled to meet them."""
    postings = prefixes.select("node", F.explode("prefix").alias("token"))
    frequent = cut(postings.groupBy("token").agg(F.count(F.lit(1)).alias("df")).where("df > 1"), "frequent")
    others = postings.join(frequent, "token").groupBy("node").agg(F.sort_array(F.collect_list(F.struct("df", "token"))).alias("found"))
    least = _sql_shared("n", percent)
    sized = prefixes.select("node", "n", F.expr(f"int(n - {_sql_needed('n', percent)} + {_sql_shared('n', percent)})").alias("p"))
    live = sized.join(others, "node").withColumn("l", F.expr(least).cast("int")).where("size(found) >= l")
    # candidates are scanned once for each posting, and verified at a cost of about n once for every k matches
    length = lambda k: f"greatest(0, p - l + {k} - (p - size(found)))"
    cost = lambda k: f"aggregate(slice(found, 1, int({length(k)})), 0D, (s, x) -> s + x.df - 1) * (1 + n / {k}D)"
    # a class may need up to as many matches as it shares at least
    costs = [f"if(l >= {k}, {cost(k)}, double('infinity'))" for k in range(1, MATCHES + 1)]
    best = live.withColumn("costs", F.expr(f"array({', '.join(costs)})")).withColumn("k", F.expr("int(greatest(1, array_position(costs, array_min(costs))))"))
    kept = cut(best.select("node", "n", "k", F.expr(f"slice(found, 1, int({length('k')}))").alias("tokens")).where("size(tokens) > 0"), "kept")
    spent(frequent)
    return kept


def _blocks(rows: str, weight: str) -> Column:
    return F.greatest(F.ceil(F.col(rows) / BLOCK_ROWS), F.ceil(F.col(weight) / BLOCK_TOKENS)).cast("int")


def _buckets(postings: DataFrame) -> DataFrame:
    """token, size and blocks of the tokens that several classes have. postings has token and n."""
    sizes = postings.groupBy("token").agg(F.count(F.lit(1)).alias("size"), F.sum("n").alias("weight")).where("size > 1")
    return sizes.select("token", "size", _blocks("size", "weight").alias("blocks"))


def _several(state: DataFrame) -> DataFrame:
    """The tokens whose classes are of more than one component and more than one home, and the number of these classes."""
    ends = state.groupBy("token").agg(F.min("component").alias("c0"), F.max("component").alias("c1"), F.min("home").alias("h0"), F.max("home").alias("h1"), F.count(F.lit(1)).alias("m"))
    return ends.where("c0 <> c1 AND h0 <> h1").select("token", "m")


def _shapes(groups: DataFrame) -> DataFrame:
    """home, m and its largest component, main, with u, the classes outside it, and numbers of blocks of these and of main; of
    homes of several components. groups has home, n, component."""
    parts = groups.groupBy("home", "component").agg(F.count(F.lit(1)).alias("m"), F.sum("n").alias("w"))
    whole = parts.groupBy("home").agg(F.sum("m").alias("m"), F.sum("w").alias("w"), F.max(F.struct("m", "w", "component")).alias("main"), F.count(F.lit(1)).alias("several")).where("several > 1")
    rest = whole.withColumns({"u": F.col("m") - F.col("main.m"), "v": F.col("w") - F.col("main.w")})
    return rest.select("home", "m", "u", F.col("main.component").alias("main"), _blocks("main.m", "main.w").alias("main_blocks"), _blocks("u", "v").alias("left_blocks"))


def _against_main(groups: DataFrame, shapes: DataFrame) -> DataFrame:
    """The classes of groups (node, home, component) as _compared() takes them."""
    placed = matched(groups, "home", shapes, "m", F.col("node")).where("main IS NOT NULL")
    return placed.select("node", "home", "component", (F.col("component") != F.col("main")).alias("left"), "left_blocks", "main_blocks")


def _compared(sets: DataFrame, placed: DataFrame, kept: DataFrame, percent: int) -> DataFrame:
    """Links (a, b) that join components of each home's classes. placed has node, home, component, whether it is left, that is
    compared with all classes of its home, and numbers of blocks of the left and of the others.

    A task compares two blocks, i of the left and j of the left from i on, or of the others, which count on after the left.
    """
    placed = cut(placed.join(kept.select("node", "k", F.col("tokens.token").alias("kept")), "node"), "placed")
    own = F.pmod(F.xxhash64("node"), F.when(F.col("left"), F.col("left_blocks")).otherwise(F.col("main_blocks"))).cast("int")
    rows = sets.join(small(placed), "node").withColumn("own", own)
    among = "transform(sequence(0, left_blocks - 1), x -> struct(least(own, x) as i, greatest(own, x) as j, own <= x as l, own >= x as r))"
    to_main = "if(main_blocks = 0, array(), transform(sequence(0, main_blocks - 1), x -> struct(own as i, left_blocks + x as j, true as l, false as r)))"
    of_main = "transform(sequence(0, left_blocks - 1), x -> struct(x as i, left_blocks + own as j, false as l, true as r))"
    tasks = rows.withColumn("task", F.explode(F.expr(f"if(left, concat({among}, {to_main}), {of_main})"))).select("home", "task.*", "node", "k", "kept", "component", "tokens")
    parts = int(sets.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    found = cut(tasks.repartition(parts, "home", "i", "j").sortWithinPartitions("home", "i", "j").mapInArrow(_task_links(percent), "a long, b long"), "links")
    spent(placed)
    return found


def _linked(docs: DataFrame, words: int, percent: int, id_col: str, text_col: str) -> DataFrame:
    """link_documents() with row (a number of its own), text_hash and component (null for rows that are alone)."""
    spark = docs.sparkSession
    ship(spark)
    made = docs.select(*_identity(docs, id_col, text_col)).mapInArrow(_prefixes(words, percent), "doc_id long, text_hash long, n long, key binary, prefix array<long>")
    made = cut(made.withColumn("row", F.monotonically_increasing_id()), "prefixes")
    rows = cut(made.drop("prefix"), "rows")  # these stay, the prefixes go when the classes have chosen among them
    grouped = rows.where("n > 0").groupBy("key").agg(F.first("n").alias("n"), F.min("doc_id").alias("least"), F.count(F.lit(1)).alias("class_size"), F.min(F.struct("row", "doc_id", "text_hash")).alias("one"))
    classes = cut(grouped.select("key", "n", "least", "class_size", F.col("one.row").alias("node"), F.col("one.doc_id").alias("_id"), F.col("one.text_hash").alias("_hash")), "classes")
    copied = cut(classes.where("class_size > 1").select("key", "node", "class_size"), "copied")
    copies = cut(matched(rows.select("key", "row"), "key", copied, "class_size", F.col("row")).where("row <> node").select("row"), "copies")
    prefixes = made.where("n > 0").select(F.col("row").alias("node"), "n", "prefix").join(small(copies), F.col("node") == F.col("row"), "left_anti")
    kept = _kept_prefixes(prefixes, percent)
    spent(made, copies)
    postings = kept.select("node", "n", "k", F.explode("tokens").alias("t")).select("node", "n", "k", "t.token")
    buckets = cut(_buckets(postings), "buckets")
    active = cut(matched(postings, "token", buckets, "size", F.col("node")).where("size IS NOT NULL"), "postings")
    homes = cut(active.groupBy("node").agg(F.first("n").alias("n"), F.max(F.struct("size", "token", "blocks")).alias("h")).select("node", "n", F.col("h.token").alias("home"), "h.blocks"), "homes")
    # the sets of the classes that may have partners, from one document of each
    chosen = cut(classes.join(small(homes.select("node")), "node", "left_semi").select("node", "_id", "_hash"), "chosen")
    texts = docs.select(*_identity(docs, id_col, text_col)).join(small(chosen), F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("text_hash") == F.col("_hash")))
    sets = cut(texts.select("node", "text").mapInArrow(_sets(words), "node long, tokens binary"), "sets")
    if sets.count() > chosen.count():  # rows that are equal in id and text
        sets = cut(sets.dropDuplicates(["node"]), "sets")
    # small homes as a whole, large ones against their first block
    pivot = F.pmod(F.xxhash64("node", F.lit("pivot")), F.col("blocks")) == 0
    links = _compared(sets, homes.select("node", "home", F.col("node").alias("component"), pivot.alias("left"), F.lit(1).alias("left_blocks"), F.when(F.col("blocks") > 1, F.col("blocks")).otherwise(0).alias("main_blocks")), kept, percent)
    found = components(links)
    # large homes, and classes whose tokens lead to more than one component and home
    known = cut(homes.join(found, "node", "left").withColumn("component", F.coalesce("component", "node")), "known")
    state = active.join(known.select("node", "home", "component"), "node").select("token", "node", "n", "k", "home", "component")
    several = cut(_several(state), "several")
    open_ = cut(matched(state, "token", several, "m", F.col("node")).where("m IS NOT NULL").drop("m"), "open")
    sized = cut(_buckets(open_), "sizes")
    ranked = matched(open_, "token", sized, "size", F.col("node")).groupBy("node").agg(F.slice(F.sort_array(F.collect_list(F.struct("size", "token")), asc=False), 1, HOMES).alias("h"), F.first("n").alias("n"), F.first("component").alias("component"))
    ranked = cut(ranked.select("node", "n", "component", F.sort_array("h.token").alias("homes")), "second-homes")
    again = ranked.select("node", F.explode("homes").alias("home"), "n", "component").unionByName(known.where("blocks > 1").select("node", "home", "n", "component"))
    again = cut(again.distinct(), "second")
    shapes = cut(_shapes(again), "shapes")
    links = links.unionByName(_compared(sets, _against_main(again, shapes), kept, percent))
    spent(again, shapes, several, sized)
    found = components(links)
    # pairs that no home has compared
    state = open_.drop("component").join(ranked.select("node", "homes"), "node").join(found, "node", "left").withColumn("component", F.coalesce("component", "node"))
    several = cut(_several(state), "several")
    left = cut(matched(state, "token", several, "m", F.col("node")).where("m IS NOT NULL").drop("m"), "left")
    shapes = cut(_shapes(left.select(F.col("token").alias("home"), "n", "component")), "shapes")
    heavy = cut(shapes.where(F.col("u") * F.col("m") > PAIRS), "heavy")
    if not heavy.isEmpty():
        links = links.unionByName(_compared(sets, _against_main(left.select("node", F.col("token").alias("home"), "n", "component"), heavy), kept, percent))
    light = cut(shapes.where(F.col("u") * F.col("m") <= PAIRS).select(F.col("home").alias("token"), "main", "m"), "light")
    few = matched(left, "token", light, "m", F.col("node")).where("main IS NOT NULL")
    columns = ("node", "n", "k", "component", "home", "homes")
    x = few.where(F.col("component") != F.col("main")).select("token", "main", *(F.col(c).alias(f"x_{c}") for c in columns))
    y = few.select("token", *(F.col(c).alias(f"y_{c}") for c in columns))
    near = (F.col("x_n") * 100 >= F.col("y_n") * percent) & (F.col("y_n") * 100 >= F.col("x_n") * percent)
    once = (F.col("y_component") == F.col("main")) | (F.col("x_node") < F.col("y_node"))
    apart_ = (F.col("x_component") != F.col("y_component")) & (F.col("x_home") != F.col("y_home")) & ~F.arrays_overlap("x_homes", "y_homes")
    met = x.join(y, "token").where(once & near & apart_)  # at most PAIRS of a token
    pairs = met.groupBy(F.least("x_node", "y_node").alias("a"), F.greatest("x_node", "y_node").alias("b")).agg(F.count(F.lit(1)).alias("shared"), F.first(F.least("x_k", "y_k")).alias("k"))
    pairs = cut(pairs.where("shared >= k").select("a", "b"), "pairs")
    asked = cut(pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct(), "asked")
    whole = sets.join(small(asked), "node", "left_semi")
    with_x = whole.select(F.col("node").alias("a"), F.col("tokens").alias("x")).join(small(pairs), "a")
    more = cut(with_x.join(whole.select(F.col("node").alias("b"), F.col("tokens").alias("y")), "b").select("a", "b", "x", "y").mapInArrow(_verified(percent), "a long, b long"), "more")
    final = found if more.isEmpty() and heavy.isEmpty() else components(links.unionByName(more))
    # only classes with copies or links are joined back to the rows
    named = cut(classes.join(final, "node", "left").where("class_size > 1 OR component IS NOT NULL").select("key", "node", "least", "class_size", F.coalesce("component", "node").alias("component")), "named")
    smallest = cut(named.groupBy("component").agg(F.min("least").alias("component_id"), F.count(F.lit(1)).alias("m")), "smallest")
    labels = cut(matched(named, "component", smallest, "m", F.col("node")).select("key", "class_size", "component_id", "component"), "labels")
    spent(copied, kept, buckets, active, homes, chosen, sets, known, several, open_, ranked, shapes, heavy, light, left, pairs, asked, more, named, smallest)
    out = matched(rows.select("row", "doc_id", "text_hash", "n", "key"), "key", labels, "class_size", F.col("row"))
    alone = F.col("class_size").isNull()
    return out.select("row", "doc_id", "text_hash", F.col("n").alias("n_shingles"), F.when(alone, F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"), F.coalesce("class_size", F.lit(1)).cast("long").alias("class_size"), "component")


def link_documents(docs: DataFrame, words: int = WORDS, percent: int = PERCENT, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of docs: doc_id, n_shingles, component_id (smallest doc_id of its component), class_size (rows with an
    equal set).

    Letters A-Z are compared in lower case; words are what ASCII white space leaves. Null texts and texts without words
    have no shingles and no links; each such row is its own component. Rows with equal sets are linked whatever their ids;
    a null id does not count as smallest unless there is no other. An empty table gives no rows; only id and text are read.
    """
    return _linked(docs, words, percent, id_col, text_col).select("doc_id", "n_shingles", "component_id", "class_size")


def drop_near_duplicates(docs: DataFrame, words: int = WORDS, percent: int = PERCENT, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """docs with one row of each component; all columns kept, whatever their names. Cases as in link_documents.

    Rows are told apart by id and text: of a component, the row with the smallest id stays (null last), of several the one with
    the smallest hash of its text, and of rows that are equal in both the one with the smallest hash of all columns.
    """
    linked = cut(_linked(docs, words, percent, id_col, text_col).where("component IS NOT NULL"), "linked")
    order = F.struct(F.col("doc_id").isNull().alias("nameless"), "doc_id", "text_hash")
    first = cut(linked.groupBy("component").agg(F.count(F.lit(1)).alias("m"), F.min(order).alias("first")).select("component", "m", F.col("first.doc_id").alias("first_id"), F.col("first.text_hash").alias("first_hash")), "first")
    told = matched(linked.select("row", "component", "doc_id", "text_hash"), "component", first, "m", F.col("row"))
    stays = F.col("doc_id").eqNullSafe(F.col("first_id")) & (F.col("text_hash") == F.col("first_hash"))
    seen = cut(told.groupBy("doc_id", "text_hash").agg(F.count(F.lit(1)).alias("times"), F.max(stays).alias("stays")).where("times > 1 OR NOT stays").select(F.col("doc_id").alias("of_id"), F.col("text_hash").alias("of_hash"), "stays"), "seen")
    own, row_id, text = apart(docs, id_col, text_col)
    names = own.columns
    keyed = own.withColumn("text_hash", F.xxhash64(row_id, text))
    marked = keyed.join(small(seen), F.col(row_id).cast("long").eqNullSafe(F.col("of_id")) & (F.col("text_hash") == F.col("of_hash")), "left")
    out = marked.where("stays IS NULL").select(*names)
    if not seen.where("stays").isEmpty():
        among = marked.where("stays").withColumn("order", F.sha2(F.to_json(F.struct(*names)), 256))
        out = out.unionByName(among.groupBy("of_id", "of_hash").agg(F.min_by(F.struct(*names), "order").alias("r")).select("r.*"))
    return restored(out, docs)
