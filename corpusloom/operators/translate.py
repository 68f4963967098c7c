"""Model calls: prompts, response parsing, batches that halve on failure, and rescue of single rows in chunks.

A backend is any function from a prompt to a text that raises ValueError on failure; it runs in the workers.
"""

from __future__ import annotations

import csv
import io
import json
import time
import urllib.error
import urllib.request
from collections.abc import Callable, Iterator
from dataclasses import replace

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.config import TranslateConfig
from corpusloom.functions.chunking import chunks_of
from corpusloom.functions.locales import described
from corpusloom.shipping import ship

Backend = Callable[[str], str]
#: Second passes go no lower with min_chunk_chars.
FLOOR = 40
RESULT = "row_id long, new_text string, state string, attempts long"


def http_backend(url: str, config: TranslateConfig) -> Backend:
    """A backend that posts prompts to a local model server, and rests config.sleep_s after each call. Calls of one partition
    follow each other, so the number of partitions bounds the load."""

    def call(prompt: str) -> str:
        body = json.dumps({"model": config.model, "prompt": prompt, "stream": False}).encode()
        request = urllib.request.Request(url, body, {"Content-Type": "application/json"})
        try:
            with urllib.request.urlopen(request, timeout=config.timeout_s) as answer:
                text = json.load(answer).get("response")
        except (OSError, urllib.error.URLError, json.JSONDecodeError) as problem:
            raise ValueError(f"the model server failed: {problem}") from problem
        finally:
            time.sleep(config.sleep_s)
        if not isinstance(text, str):
            raise ValueError("the model server sent no text")
        return text

    return call


def system_part(config: TranslateConfig) -> str:
    """What every prompt begins with: the task, in the locales' own descriptions, and its rules."""
    source, target = described(config.source_locale)[1], described(config.target_locale)[1]
    return f"You translate statements of people about how they feel from {source} to {target}. Keep meaning, tone, numbers, names and line breaks; add no notes, advice or judgement."


def batch_prompt(rows: list[dict], config: TranslateConfig) -> str:
    """Task, rules and form of the answer in the first line; then the rows as JSON."""
    shape = "CSV with the header row_id,translation and quoted texts" if config.response_format == "csv" else "a JSON array of objects with row_id and translation"
    return f"{system_part(config)} Answer with {shape}, every row_id once.\n{json.dumps(rows, ensure_ascii=False, indent=2)}"


def chunk_prompt(text: str, config: TranslateConfig) -> str:
    """Task and rules in the first line; then a piece of a longer text."""
    return f"{system_part(config)} The text is a part of a longer one. Answer with its translation only.\n{text}"


def unfenced(text: str) -> str:
    lines = text.strip().split("\n")
    return "\n".join(lines[1:-1]).strip() if len(lines) >= 3 and lines[0].startswith("```") and lines[-1].strip() == "```" else text.strip()


def parsed_response(text: str, kind: str) -> list[tuple[int, str]]:
    """(row id, text) pairs of a CSV or JSON answer; ValueError if it is not of that form."""
    text = unfenced(text)
    if kind == "json":
        items = json.loads(text)
        if not isinstance(items, list) or not all(isinstance(x, dict) for x in items):
            raise ValueError("not an array of objects")
        if not all(type(x.get("row_id")) is int for x in items):
            raise ValueError("a row id is no whole number")
        return [(x["row_id"], str(x.get("translation") or "")) for x in items]
    reader = csv.DictReader(io.StringIO(text))
    if not {"row_id", "translation"} <= set(reader.fieldnames or ()):
        raise ValueError("the header lacks a column")
    rows = [(int(r["row_id"]), r["translation"] or "") for r in reader if (r["row_id"] or "").strip()]
    if not rows:
        raise ValueError("no rows")
    return rows


def checked(expected: list[int], rows: list[tuple[int, str]]) -> dict[int, str]:
    """Texts by id if ids and rows match one to one; else ValueError."""
    out: dict[int, str] = {}
    for i, text in rows:
        if not text.strip():
            raise ValueError(f"row {i} is blank")
        if i not in expected:
            raise ValueError(f"row {i} was not asked for")
        if i in out:
            raise ValueError(f"row {i} came twice")
        out[i] = text.strip()
    if missing := sorted(set(expected) - set(out))[:10]:
        raise ValueError(f"rows are missing: {missing}")
    return out


def suspicious_fragment(source: str, output: str) -> str | None:
    """Python form of functions.text.fragment_problem, for use between calls."""
    out, n = output.strip(), len(source.strip())
    if not out:
        return "empty_fragment"
    if "```" in out:
        return "markdown_fence_detected"
    if out.lower().startswith(("row_id,", "{", "[")):
        return "structured_output_detected"
    return f"fragment_too_short:{len(out)}/{n}" if n >= 220 and len(out) < max(50, int(n * 0.22)) else None


def next_limit(length: int, limit: int, least: int) -> int:
    """Chunk size after a failure: half the limit or half the text, not below `least`."""
    return max(least, min(limit // 2, max(least, length // 2)))


def rescued_fragment(text: str, backend: Backend, config: TranslateConfig, limit: int) -> str:
    """A fragment's translation; on failure that of ever smaller chunks, until one is as small as allowed."""
    try:
        out = backend(chunk_prompt(text, config)).strip()
        problem = suspicious_fragment(text, out)
    except ValueError as error:
        out, problem = "", str(error)
    if problem is None:
        return out
    smaller = next_limit(len(text), limit, config.min_chunk_chars)
    parts = chunks_of(text, smaller) if len(text) > config.min_chunk_chars and smaller < len(text) else []
    if len(parts) <= 1:
        raise ValueError(problem)
    return "\n\n".join(rescued_fragment(p, backend, config, smaller) for p in parts)


def in_chunks(text: str, backend: Backend, config: TranslateConfig) -> str:
    return "\n\n".join(rescued_fragment(c, backend, config, config.chunk_chars) for c in chunks_of(text, config.chunk_chars)).strip()


def run_batches(rows: list[dict], backend: Backend, config: TranslateConfig) -> Iterator[tuple[int, str, str, int]]:
    """(row_id, text, state, attempts) of rows in order. A failed batch is halved in place; after a success the next is full.
    At the smallest size a single row is rescued in chunks; what still fails keeps its error as its state."""
    at, size, tries = 0, config.batch_size, 0
    while at < len(rows):
        batch = rows[at : at + size]
        ids = [r["row_id"] for r in batch]
        tries += 1
        try:
            found = checked(ids, parsed_response(backend(batch_prompt(batch, config)), config.response_format))
        except ValueError as error:
            if len(batch) > config.min_batch_size:
                size = max(config.min_batch_size, len(batch) // 2)
                continue
            for r in batch:
                text, state = "", f"failed:{error}"
                if len(batch) == 1:
                    try:
                        text, state = in_chunks(r["source_text"], backend, config), "success"
                    except ValueError as problem:
                        state = f"failed:{problem}"
                yield r["row_id"], text, state, tries
        else:
            for r in batch:
                yield r["row_id"], found[r["row_id"]], "success", tries
        at, size, tries = at + len(batch), config.batch_size, 0


def translated(df: DataFrame, backend: Backend, config: TranslateConfig = TranslateConfig()) -> DataFrame:
    """row_id, new_text, state, attempts of rows (row_id, label, source_text). Partitions call the backend side by side.

    Whoever reads the result twice calls the backend twice: write it first, as the passes do.
    """
    ship(df.sparkSession)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            rows = frame[["row_id", "label", "source_text"]].to_dict("records")
            yield pd.DataFrame(list(run_batches(rows, backend, config)), columns=["row_id", "new_text", "state", "attempts"])

    return df.select("row_id", F.coalesce("label", F.lit("")).alias("label"), F.coalesce("source_text", F.lit("")).alias("source_text")).mapInPandas(run, RESULT)


def translated_in_chunks(df: DataFrame, backend: Backend, config: TranslateConfig = TranslateConfig()) -> DataFrame:
    """The same for rows that are translated chunk by chunk, as second passes do: with chunks of FLOOR characters at least."""
    ship(df.sparkSession)
    config = replace(config, min_chunk_chars=max(FLOOR, config.min_chunk_chars))

    def one(text: str) -> tuple[str, str]:
        try:
            out = in_chunks(text, backend, config)
            return (out, "success") if out else ("", "empty_retry")
        except ValueError as problem:
            return "", f"failed:{problem}"

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            rows = [(i, *one(t), 1) for i, t in zip(frame["row_id"], frame["source_text"], strict=True)]
            yield pd.DataFrame(rows, columns=["row_id", "new_text", "state", "attempts"])

    return df.select("row_id", F.coalesce("source_text", F.lit("")).alias("source_text")).mapInPandas(run, RESULT)


def whispering_backend(prompt: str) -> str:
    """A stand-in model: lower case; as CSV for a batch prompt."""
    head, _, body = prompt.partition("\n")
    if "every row_id once" not in head:
        return body.lower()
    out = io.StringIO()
    writer = csv.writer(out)
    writer.writerow(["row_id", "translation"])
    writer.writerows((r["row_id"], r["source_text"].lower()) for r in json.loads(body))
    return out.getvalue()


def failing_over(limit: int) -> Backend:
    """A stand-in model that fails for prompts whose body is longer than `limit`."""

    def call(prompt: str) -> str:
        if len(prompt.partition("\n")[2]) > limit:
            raise ValueError("too long")
        return whispering_backend(prompt)

    return call
