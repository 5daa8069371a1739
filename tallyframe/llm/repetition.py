"""Quality rules by repetition coverage: how many characters of a text lie inside duplicated
lines and duplicated word n-grams, from rolling hashes of several lengths.

For each length ``n`` in ``COVER`` a word belongs to the coverage if any n-gram over it occurs
twice or more in the text (the first occurrence included). For the short lengths in ``TOP`` the
share is that of the most frequent n-gram, its length times its count, if that is at least ``TOP_LEAST``. Shares are
of the characters in words, so white space counts nowhere.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyframe.llm.base import U64, Rolling, mix, text_runs, words_of

# Shares of characters from which a text counts as repetitive: the most frequent 2- to 4-gram,
# duplicated 5- to 10-grams, duplicated lines. Shares for single n-grams are the published ones
# for web text; those for coverage are set above the base rule's 20 %, so that a text with one passage
# quoted twice stays.
TOP = {2: 0.20, 3: 0.18, 4: 0.16}
COVER = {5: 0.30, 6: 0.29, 7: 0.28, 8: 0.27, 9: 0.26, 10: 0.25}
LINE_CHARS = 0.30
#: Shares of a text's lines that equal an earlier line; counts only in texts with so many lines.
LINES = 0.30
LEAST_LINES = 10
#: A most frequent n-gram says something only if it occurs at least so often.
TOP_LEAST = 4
#: Words of a window of the base rule.
WINDOW = 5
SYMBOLS = b"#*$%&|<>"

COUNTS = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "dup_line_chars", "n_repeat_words")
SHARES = tuple(f"top_{n}" for n in TOP) + tuple(f"dup_{n}" for n in COVER)
SCHEMA = pa.schema([("doc_id", pa.int64())] + [(c, pa.int64()) for c in COUNTS] + [(f"{c}_chars", pa.int64()) for c in SHARES])

_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(SYMBOLS)] = True
_BREAK = 0x0A


def _groups(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of each key: its group's number and whether it is the group's first place; sizes by group."""
    order = np.argsort(keys, kind="stable")
    ranked = keys[order]
    new = np.ones(len(keys), bool)
    new[1:] = ranked[1:] != ranked[:-1]
    number = np.empty(len(keys), np.int64)
    number[order] = np.cumsum(new) - 1
    first = np.zeros(len(keys), bool)
    first[order[new]] = True
    return number, first, np.diff(np.append(np.flatnonzero(new), len(keys)))


def _covered(starts: np.ndarray, width: int, n: int) -> np.ndarray:
    """Which of ``n`` words lie in a window of ``width`` words that begins at one of ``starts``."""
    edge = np.zeros(n + 1, np.int64)
    edge[np.flatnonzero(starts)] += 1
    edge[np.flatnonzero(starts) + width] -= 1
    return np.cumsum(edge[:n]) > 0


def measure(words: np.ndarray, chars: np.ndarray) -> dict[str, int]:
    """The repetition measures of one text from its word hashes and word lengths in characters."""
    n = len(words)
    out = dict.fromkeys(("n_repeat_words", *(f"{c}_chars" for c in SHARES)), 0)
    rolled = words
    sums = np.concatenate([[0], np.cumsum(chars)])
    for width in range(2, max(COVER) + 1):
        if n < width:
            break
        rolled = mix(rolled[: n - width + 1] * U64(0x9E3779B97F4A7C15) + words[width - 1 :])
        number, _, sizes = _groups(rolled)
        if sizes.max() < 2:
            break  # no longer n-gram can occur twice either
        if width in TOP and (most := int(sizes.max())) >= TOP_LEAST:
            gram = sums[width:] - sums[:-width]
            out[f"top_{width}_chars"] = min(most * int(gram[sizes[number] == most].max()), int(sums[-1]))
        if width in COVER:
            inside = _covered(sizes[number] > 1, width, n)
            out[f"dup_{width}_chars"] = int(chars[inside].sum())
            if width == WINDOW:
                out["n_repeat_words"] = int(inside.sum())
    return out


def _lines(data: np.ndarray, rolling: Rolling, base: int, end: int, start: np.ndarray, chars: np.ndarray) -> tuple[int, int, int]:
    """Lines with a word, those of them equal to an earlier one, and the characters of the latter."""
    cuts = np.flatnonzero(data[base:end] == _BREAK) + base
    froms = np.concatenate([[base], cuts + 1])
    tos = np.concatenate([cuts, [end]])
    first = np.searchsorted(start, froms)
    last = np.searchsorted(start, tos)
    full = last > first
    if not full.any():
        return 0, 0, 0
    keys = mix(rolling.of(froms[full], tos[full]))
    _, fresh, _ = _groups(keys)
    sums = np.concatenate([[0], np.cumsum(chars)])
    return int(full.sum()), int((~fresh).sum()), int((sums[last[full]] - sums[first[full]])[~fresh].sum())


def _measure_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for at, to, data, offsets in text_runs(batch.column(1)):
            start, end, counts = words_of(data, offsets)
            rolling = Rolling(data)
            hashes = mix(rolling.of(start, end))
            leads = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
            chars = leads[end] - leads[start]
            symbols = np.concatenate([[0], np.cumsum(_SYMBOL[data])])[offsets]
            first = np.concatenate([[0], np.cumsum(counts)])
            for i in range(to - at):
                own = slice(first[i], first[i + 1])
                lines, same, same_chars = _lines(data, rolling, offsets[i], offsets[i + 1], start[own], chars[own])
                rows.append(
                    {"n_words": int(counts[i]), "word_chars": int(chars[own].sum()), "n_symbols": int(symbols[i + 1] - symbols[i]),
                     "n_lines": lines, "n_dup_lines": same, "dup_line_chars": same_chars} | measure(hashes[own], chars[own])
                )
        columns = [batch.column(0)] + [pa.array([r[f.name] for r in rows], pa.int64()) for f in list(SCHEMA)[1:]]
        yield pa.RecordBatch.from_arrays(columns, schema=SCHEMA)


def repetition(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Measures of every text: one row per row of ``docs``, in one pass without a shuffle.

    A null text has no words, so all its counts are 0. Nulls, repeated rows and other columns of
    ``docs`` make no difference: each row is measured by itself, and only the id is carried along.
    """
    types = ", ".join(f"{f.name} long" for f in SCHEMA)
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")).mapInArrow(_measure_batches, types)


def repetitive(top: dict[int, float] = TOP, cover: dict[int, float] = COVER, line_chars: float = LINE_CHARS, lines: float = LINES) -> Column:
    """Whether measures reach any share; false for a text without words."""
    over = lambda chars, share: F.col(chars) > share * F.col("word_chars")
    found = over("dup_line_chars", line_chars) | ((F.col("n_lines") >= LEAST_LINES) & (F.col("n_dup_lines") > lines * F.col("n_lines")))
    for n, share in top.items():
        found = found | over(f"top_{n}_chars", share)
    for n, share in cover.items():
        found = found | over(f"dup_{n}_chars", share)
    return found


def quality(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Measures with the base verdict (``base_failed``) and the verdict of all rules (``kept``)."""
    failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    return repetition(docs, id_col, text_col).withColumn("base_failed", failed).withColumn("kept", ~failed & ~repetitive())
