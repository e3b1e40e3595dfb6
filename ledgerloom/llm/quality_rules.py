"""Quality rules: word-level suffix arrays find the repeated parts of each text.

Suffixes of all texts of a slice are sorted together by prefix doubling on ranks that
carry the text, so a match never leaves its text. The longest common prefix of
neighbours gives each maximal repeat; their spans are united. Texts without a repeated
run of ``min_words`` words leave the doubling early. One map pass, no shuffle.

Defined results: a NULL text has no words; it and every text of under ``min_length``
words fail; repeated rows each get their own row; an empty table gives an empty one;
``*_words`` columns of the input are never read.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.words import Words, slices

# The characters that count as symbols.
SYMBOLS = "#*$%&|<>"

_IS_SYMBOL = np.zeros(256, bool)
_IS_SYMBOL[list(SYMBOLS.encode())] = True


@dataclass(frozen=True)
class Rules:
    """Limits of a clean text.

    ``window`` words make the shortest repeat that counts; at most ``max_covered``
    hundredths of the words may lie in repeats, no repeat may be longer than
    ``max_repeat`` words, and symbols may make ``max_symbols`` hundredths of the word
    characters.
    """

    min_length: int = 20
    window: int = 8
    max_covered: int = 30
    max_repeat: int = 100
    max_symbols: int = 5


def _ranks(key: np.ndarray) -> np.ndarray:
    return np.unique(key, return_inverse=True)[1].astype(np.int32)


def _double(rank: np.ndarray, step: int) -> np.ndarray:
    after = np.zeros(len(rank), np.int64)
    after[: max(len(rank) - step, 0)] = rank[step:] + 1
    return _ranks(rank.astype(np.int64) * (len(rank) + 1) + after)


def suffix_repeats(tokens: np.ndarray, text: np.ndarray) -> np.ndarray:
    """Words that the suffix at each place shares with some other suffix of its text.

    ``tokens`` are numbered words, ``text`` the (ascending) text of each.
    """
    n = len(tokens)
    if not n:
        return np.zeros(0, np.int64)
    rank = _ranks(text.astype(np.int64) * (int(tokens.max()) + 1) + tokens)
    levels, step = [rank], 1
    while rank.max() < n - 1:
        rank = _double(rank, step)
        levels.append(rank)
        step *= 2
    order = np.empty(n, np.int64)
    order[rank] = np.arange(n)
    a, b = order[:-1].copy(), order[1:].copy()
    common = np.zeros(n - 1, np.int64)
    for level in range(len(levels) - 1, -1, -1):
        inside = (a < n) & (b < n)
        same = np.zeros(n - 1, bool)
        same[inside] = levels[level][a[inside]] == levels[level][b[inside]]
        move = same.astype(np.int64) << level
        common += move
        a += move
        b += move
    longest = np.zeros(n, np.int64)
    longest[order[1:]] = common
    longest[order[:-1]] = np.maximum(longest[order[:-1]], common)
    return longest


def repeats(words: Words, window: int) -> tuple[np.ndarray, np.ndarray]:
    """Of each text: words covered by repeats of ``window`` words or more, and the longest repeat (0 below ``window``)."""
    n_texts = len(words.first) - 1
    covered, longest = np.zeros(n_texts, np.int64), np.zeros(n_texts, np.int64)
    if not len(words):
        return covered, longest
    tokens, spelled = words.ids()
    left, text = np.arange(len(words)), words.text
    rank, step = _ranks(text * len(spelled) + tokens), 1
    while step <= window and len(left):
        # Whole texts stay as long as some run of `step` words in them occurs twice.
        twice = np.bincount(rank)[rank] > 1
        alive = np.zeros(n_texts, bool)
        alive[text[twice]] = True
        keep = alive[text]
        left, text = left[keep], text[keep]
        if step * 2 > window or not len(left):
            break
        rank = _double(_ranks(rank[keep]), step)
        step *= 2
    if not len(left):
        return covered, longest
    run = suffix_repeats(tokens[left], text)
    run[run < window] = 0
    np.maximum.at(longest, text, run)
    begins = np.flatnonzero(run)
    edge = np.zeros(len(left) + 1, np.int64)
    np.add.at(edge, begins, 1)
    np.add.at(edge, begins + run[begins], -1)
    inside = np.cumsum(edge[:-1]) > 0
    return covered + np.bincount(text[inside], minlength=n_texts), longest


def duplicate_lines(raw: bytes) -> int:
    """Lines with a word that equal an earlier line of the text."""
    lines = [line for line in raw.split(b"\n") if line.strip()]
    return len(lines) - len(set(lines))


def measure(texts: pa.Array, window: int) -> dict[str, np.ndarray]:
    """The measures of each text; NULL counts as empty."""
    words = Words(texts)
    covered, longest = repeats(words, window)
    blob, ends = words.raw.tobytes(), words.offsets.tolist()
    symbols = np.concatenate([[0], np.cumsum(_IS_SYMBOL[words.raw])])
    return {
        "n_words": np.diff(words.first),
        "word_chars": words.per_text(words.lengths()),
        "n_symbols": symbols[words.offsets[1:]] - symbols[words.offsets[:-1]],
        "n_dup_lines": np.array([duplicate_lines(blob[a:b]) for a, b in zip(ends, ends[1:])], np.int64),
        "n_repeat_words": covered,
        "longest_repeat": longest,
    }


MEASURES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "longest_repeat"]


def quality_measures(df: DataFrame, text: str = "text", window: int = 8, keep: tuple[str, ...] = ()) -> DataFrame:
    """The columns ``keep`` of ``df`` and the measures of its texts (all long)."""
    def work(batches):
        for batch in batches:
            for part in slices(batch, "__text"):
                found = measure(part.column(part.num_columns - 1), window)
                yield pa.RecordBatch.from_arrays(
                    [part.column(i) for i in range(part.num_columns - 1)] + [pa.array(found[m], pa.int64()) for m in MEASURES],
                    names=names,
                )

    narrow = df.select(*[df[f"`{c}`"] for c in keep], df[f"`{text}`"].alias("__text"))
    names = [*keep, *MEASURES]
    schema = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in narrow.schema.fields[:-1]) + ", ".join(f"{m} long" for m in MEASURES)
    return narrow.mapInArrow(work, schema)


def verdicts(measures: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """Adds ``base_failed`` (too short, or too much in repeats) and ``kept``."""
    base = (F.col("n_words") < rules.min_length) | (100 * F.col("n_repeat_words") > rules.max_covered * F.col("n_words"))
    clean = (F.col("longest_repeat") <= rules.max_repeat) & (100 * F.col("n_symbols") <= rules.max_symbols * F.col("word_chars"))
    return measures.withColumn("base_failed", base).withColumn("kept", ~base & clean)


def keep_clean(df: DataFrame, text: str = "text", rules: Rules = Rules()) -> DataFrame:
    """The rows of ``df`` whose text passes, unchanged."""
    marked = quality_measures(df, text, rules.window, tuple(df.columns)) if not set(df.columns) & set(MEASURES) else None
    if marked is None:
        plain = df.toDF(*[f"__c{i}" for i in range(len(df.columns))])
        marked = quality_measures(plain, f"__c{df.columns.index(text)}", rules.window, tuple(plain.columns))
        return verdicts(marked, rules).filter("kept").select(*plain.columns).toDF(*df.columns)
    return verdicts(marked, rules).filter("kept").select(*[F.col(f"`{c}`") for c in df.columns])
