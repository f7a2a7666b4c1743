"""Quality rules: plain measures of a text, and how well public vocabularies fit it.

Fertility is measured over the words of a text, each encoded by itself: characters per token, the share of byte-fallback
tokens, and the entropy of the tokens as a share of the most that so many tokens can have. Each language, and within it
each class of lengths (powers of two of the token count), has its own bands, from quartiles over all of its documents.
Quartiles of a class are drawn towards those of its language, and these towards those of all documents, the more so the
fewer documents there are, without a size at which the rule changes. Outside the bands of any vocabulary a document is
rejected.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from statledger.llm.cluster import written
from statledger.llm.textarrays import NOT_WHITE, mix, slices, sums_by_text, words
from statledger.llm.vocabularies import vocabulary

SYMBOLS = "#*$%&|<>"
REPEAT_WINDOW = 5
MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20
SLICE_BYTES = 1 << 20

_symbol = np.zeros(256, dtype=bool)
_symbol[list(SYMBOLS.encode())] = True
_line = np.ones(256, dtype=bool)
_line[10] = False

MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_tokens", "n_byte_tokens")
FERTILITY = ("chars_per_token", "byte_share", "entropy_share")


@dataclass
class Bands:
    """A document is outside if it is more than ``quartiles`` interquartile ranges, and ``slack``, beyond the quartiles
    of its class. A class of n documents has n votes on them, and its language ``prior``; so has the language towards all
    documents."""

    quartiles: float = 3.0
    slack: tuple[float, float, float] = (0.25, 0.02, 0.05)
    prior: float = 50.0


def fertility(vocabularies: int) -> list[str]:
    """Names of the measures of each vocabulary; those after the first are numbered."""
    return [n if k == 0 else f"{n}_{k + 1}" for k in range(vocabularies) for n in FERTILITY]


def measure(column: pa.Array, tokenizer_paths: Sequence[str]) -> dict[str, np.ndarray]:
    """All measures of each text; null is empty. Token counts are the first vocabulary's."""
    own = words(column, NOT_WHITE, lower=False)
    count = len(column)
    out = {"n_words": own.counts}
    inside = np.zeros(len(own.data) + 1, dtype=np.int64)
    inside[1:] = np.cumsum(NOT_WHITE[own.data])
    points = np.zeros(len(own.data) + 1, dtype=np.int64)
    points[1:] = np.cumsum((own.data & 0xC0) != 0x80)
    out["word_chars"] = sums_by_text(own.first, points[own.end] - points[own.start])
    lines = words(column, _line, lower=False)
    symbols = np.concatenate([[0], np.cumsum(_symbol[own.data])])
    out["n_symbols"] = sums_by_text(own.first, symbols[own.end] - symbols[own.start])
    filled = np.flatnonzero(inside[lines.end] > inside[lines.start])
    text = lines.text[filled]
    _, at = np.unique(lines.hashes[filled] ^ mix(text + 1), return_index=True)
    out["n_dup_lines"] = np.bincount(text, minlength=count) - np.bincount(text[at], minlength=count)
    at, value = own.windows(REPEAT_WINDOW)
    _, back, times = np.unique(value ^ mix(own.text[at] + 1), return_inverse=True, return_counts=True)
    again = at[times[back] > 1]
    edge = np.zeros(len(own.start) + 1, dtype=np.int64)
    np.add.at(edge, again, 1)
    np.add.at(edge, again + REPEAT_WINDOW, -1)
    out["n_repeat_words"] = sums_by_text(own.first, np.cumsum(edge)[:-1] > 0)
    names = iter(fertility(len(tokenizer_paths)))
    for path in tokenizer_paths:
        pieces = vocabulary(path)
        ids, first = pieces.encode(column)
        n_tokens, n_byte_tokens = np.diff(first), sums_by_text(first, pieces.is_byte[ids])
        out.setdefault("n_tokens", n_tokens)
        out.setdefault("n_byte_tokens", n_byte_tokens)
        key = np.repeat(np.arange(count), n_tokens) << 32 | ids
        key, times = np.unique(key, return_counts=True)
        share = times / np.maximum(1, n_tokens[key >> 32])
        entropy = np.bincount(key >> 32, -share * np.log2(share), minlength=count)
        out[next(names)] = out["word_chars"] / np.maximum(1, n_tokens)
        out[next(names)] = n_byte_tokens / np.maximum(1, n_tokens)
        out[next(names)] = entropy / np.log2(np.maximum(2, n_tokens))
    return out


def measures(docs: DataFrame, tokenizer_paths: Sequence[str]) -> DataFrame:
    """doc_id, lang and the measures of every row of ``docs``; other columns are ignored."""
    names = fertility(len(tokenizer_paths))
    source = docs.select("doc_id", "lang", "text")
    schema = T.StructType([source.schema["doc_id"], source.schema["lang"]])
    for name in MEASURES:
        schema = schema.add(name, T.LongType())
    for name in names:
        schema = schema.add(name, T.DoubleType())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, max_bytes=SLICE_BYTES):
            found = measure(batch.column("text"), tokenizer_paths)
            arrays = [batch.column("doc_id"), batch.column("lang")]
            arrays += [pa.array(found[n], pa.int64()) for n in MEASURES] + [pa.array(found[n], pa.float64()) for n in names]
            yield pa.RecordBatch.from_arrays(arrays, ["doc_id", "lang", *MEASURES, *names])

    return source.mapInArrow(run, schema)


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))


def _limits(found: DataFrame, level: str, keys: list[str], names: Sequence[str]) -> DataFrame:
    """Quartiles and number of documents of each group, with names that begin with the level's."""
    quartiles = [F.percentile_approx(n, [0.25, 0.75], 10000).alias(f"__{level}_{n}") for n in names]
    limits = found.groupBy(*keys).agg(F.count("*").alias(f"__{level}_docs"), *quartiles)
    return limits.withColumnsRenamed({k: f"__{level}_{k}" for k in keys})


def judge(docs: DataFrame, tokenizer_paths: str | Sequence[str], bands: Bands | None = None) -> DataFrame:
    """The measures of every row with base_failed, in_bands and kept.

    Texts that are null or without words have measures of 0 and fail. A null lang is a language of its own. Rows are
    judged one by one, so copies get the same verdict; an empty table gives no rows. The measures are written once to the
    shared folder, because the bands need all of them.
    """
    paths = [tokenizer_paths] if isinstance(tokenizer_paths, str) else list(tokenizer_paths)
    return verdicts(written(measures(docs, paths), "quality"), fertility(len(paths)), bands or Bands())


def verdicts(found: DataFrame, names: Sequence[str], bands: Bands) -> DataFrame:
    """Verdicts from the measures; ``names`` are those that have bands."""
    columns = found.columns
    found = found.withColumn("__class", F.floor(F.log2(F.greatest(F.col("n_tokens"), F.lit(1)))))
    by_class, by_lang = (_limits(found, level, keys, names) for level, keys in (("class", ["lang", "__class"]), ("lang", ["lang"])))
    # One row, whose few numbers are literals of the plan.
    of_all = _limits(found, "all", [], names).first()
    same_lang = found["lang"].eqNullSafe(by_class["__class_lang"])
    found = found.join(by_class, same_lang & (found["__class"] == by_class["__class___class"]))
    found = found.join(by_lang, found["lang"].eqNullSafe(by_lang["__lang_lang"]))

    def drawn(level: str, name: str, quartile: int, towards: Column) -> Column:
        n = F.col(f"__{level}_docs")
        return (n * F.col(f"__{level}_{name}")[quartile] + bands.prior * towards) / (n + bands.prior)

    inside = F.lit(True)
    for place, name in enumerate(names):
        whole = of_all[f"__all_{name}"] or (0.0, 0.0)
        low, high = (drawn("class", name, q, drawn("lang", name, q, F.lit(whole[q]))) for q in (0, 1))
        width = F.greatest((high - low) * bands.quartiles, F.lit(bands.slack[place % len(FERTILITY)]))
        above = F.col(name) <= high + width
        # A low share of byte tokens is no fault, nor is a high entropy.
        below = F.col(name) >= low - width
        inside &= (above & below, above, below)[place % len(FERTILITY)]
    return (
        found.withColumn("base_failed", base_failed())
        .withColumn("in_bands", inside)
        .withColumn("kept", ~F.col("base_failed") & F.col("in_bands"))
        .select(*columns, "base_failed", "in_bands", "kept")
    )
