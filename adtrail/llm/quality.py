"""Quality rules whose cutoffs come from the data: quantile sketches per language and source, joined back to filter.

Every document gets a handful of measures. For each (language, source, measure) a quantile sketch with logarithmic
buckets counts the documents per bucket; a bucket's values differ by a factor of ``GROWTH`` at most, so a quantile is
known to within that factor. Sketches merge by adding counts, in any order, so the thresholds are the same on every
run and for every partitioning. A measure's cutoff in a group is

    median + REACH * (upper quartile - median + SLACK of the measure)

and the same downwards for measures with a lower side. Groups in which few documents differ get their width from the
slack; groups in which many do widen on their own. A document is kept if it passes the base rules and breaks no cutoff.

Defined cases: a null text has no words and fails the base rules; null language or source form groups of their own;
repeated rows count as often as they occur; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from adtrail.llm.store import fresh_folder, written
from adtrail.llm.words import CONTINUATION, blocks, gram_hashes, hashed

GROWTH = 1.02
REACH = 6.0
WINDOW = 8
SYMBOLS = b"#*$%&|<>"

#: Measure to (slack, whether it has a lower side). Shares run from 0 to 1.
MEASURES = {
    "symbol_share": (0.01, False),
    "repeat_share": (0.05, False),
    "dup_line_share": (0.06, False),
    "upper_share": (0.04, False),
    "mark_share": (0.02, False),
    "mean_word": (0.4, True),
}

_MARKS = bytes(c for c in range(33, 127) if not chr(c).isalnum())
_UPPER = bytes(range(65, 91))
_LETTERS = _UPPER + bytes(range(97, 123))


def repeated_words(words: list[bytes], ids: np.ndarray | None = None) -> int:
    """Words that stand in a window of WINDOW words found twice or more."""
    count = len(words) - WINDOW + 1
    if count < 2:
        return 0
    grams = gram_hashes(hashed(words) if ids is None else ids, WINDOW)
    order = np.argsort(grams, kind="stable")
    ranked = grams[order]
    same = ranked[1:] == ranked[:-1]
    if not same.any():
        return 0
    twice = np.zeros(count, bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    found: dict[tuple, list[int]] = {}
    for at in np.flatnonzero(twice).tolist():  # equal hashes are only candidates
        found.setdefault(tuple(words[at : at + WINDOW]), []).append(at)
    edges = np.zeros(len(words) + 1, np.int64)
    for places in found.values():
        if len(places) > 1:
            np.add.at(edges, places, 1)
            np.add.at(edges, np.array(places) + WINDOW, -1)
    return int((np.cumsum(edges) > 0).sum())


def measured(data: bytes | None) -> tuple:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, lines with a word, upper-case letters, letters, marks."""
    data = data or b""
    words = data.split()
    if not words:
        return 0, 0, len(data) - len(data.translate(None, SYMBOLS)), 0, 0, 0, 0, 0, 0
    joined = b"".join(words)
    chars = len(joined) if joined.isascii() else len(joined.translate(None, CONTINUATION))
    lines = [line for line in data.split(b"\n") if line.strip()]
    without = lambda drop: len(joined) - len(joined.translate(None, drop))
    return (
        len(words), chars, without(SYMBOLS), len(lines) - len(set(lines)), repeated_words(words),
        len(lines), without(_UPPER), without(_LETTERS), without(_MARKS),
    )


_COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper", "n_letters", "n_marks"]


def measure(docs: DataFrame, keep: list[str], text: str = "text") -> DataFrame:
    """(``keep`` columns, counts) per row of ``docs``."""
    slim = docs.select(*[F.col(c).alias(f"_k{i}") for i, c in enumerate(keep)], F.col(text).cast("string").cast("binary").alias("_text"))
    kinds = [f"{f.name} {f.dataType.simpleString()}" for f in slim.schema if f.name != "_text"]

    def run(batches):
        for batch in batches:
            for start, end in blocks(batch, "_text"):
                part = batch.slice(start, end - start)
                rows = [measured(data) for data in part.column("_text").to_pylist()]
                columns = [pa.array([r[i] for r in rows], pa.int64()) for i in range(len(_COUNTS))]
                yield pa.RecordBatch.from_arrays([*part.columns[:-1], *columns], names=[*part.schema.names[:-1], *_COUNTS])

    out = slim.mapInArrow(run, ", ".join([*kinds, *[f"{c} bigint" for c in _COUNTS]]))
    for i, c in enumerate(keep):
        out = out.withColumnRenamed(f"_k{i}", c)
    return out


def _share(part: str, whole: str) -> Column:
    return F.when(F.col(whole) > 0, F.col(part) / F.col(whole)).otherwise(F.lit(0.0))


def _values() -> dict[str, Column]:
    return {
        "symbol_share": _share("n_symbols", "word_chars"),
        "repeat_share": _share("n_repeat_words", "n_words"),
        "dup_line_share": _share("n_dup_lines", "n_lines"),
        "upper_share": _share("n_upper", "n_letters"),
        "mark_share": _share("n_marks", "word_chars"),
        "mean_word": _share("word_chars", "n_words"),
    }


def sketch(rows: DataFrame, groups: list[str], values: dict[str, Column]) -> DataFrame:
    """(groups, measure, bucket, n): mergeable by adding n. Bucket b holds values up to GROWTH^b; 0 has the least bucket."""
    bucket = lambda v: F.when(v > 1e-6, F.ceil(F.log(v) / F.lit(float(np.log(GROWTH)))).cast("int")).otherwise(F.lit(-(10**6)))
    pairs = F.explode(F.array(*[F.struct(F.lit(name).alias("measure"), bucket(v).alias("bucket")) for name, v in values.items()]))
    return rows.select(*groups, pairs.alias("p")).groupBy(*groups, "p.measure", "p.bucket").agg(F.count("*").alias("n"))


def quantiles(sketches: DataFrame, groups: list[str], at: dict[str, float]) -> DataFrame:
    """(groups, measure, a column per entry of ``at``): the upper end of the bucket in which the quantile lies.

    A group has no more than some hundreds of buckets per measure, whatever the number of documents.
    """
    group = [*groups, "measure"]
    running = sketches.withColumn("upto", F.sum("n").over(Window.partitionBy(*group).orderBy("bucket"))).withColumn("all", F.sum("n").over(Window.partitionBy(*group)))
    value = F.when(F.col("bucket") > -(10**6), F.pow(F.lit(GROWTH), F.col("bucket"))).otherwise(F.lit(0.0))
    return running.groupBy(*group).agg(*[F.min(F.when(F.col("upto") >= F.col("all") * q, value)).alias(name) for name, q in at.items()])


def cutoffs(rows: DataFrame, groups: list[str]) -> DataFrame:
    """(groups, <measure>_most, <measure>_least): one row per group."""
    q = quantiles(sketch(rows, groups, _values()), groups, {"low": 0.25, "mid": 0.5, "high": 0.75})
    one = lambda name, c: F.max(F.when(F.col("measure") == name, F.col(c)))
    out = []
    for name, (slack, lower) in MEASURES.items():
        out.append((one(name, "mid") + REACH * (one(name, "high") - one(name, "mid") + slack)).alias(f"{name}_most"))
        if lower:
            out.append((one(name, "mid") - REACH * (one(name, "mid") - one(name, "low") + slack)).alias(f"{name}_least"))
    return q.groupBy(*groups).agg(*out)


def base_failed() -> Column:
    return (F.col("n_words") < 20) | (F.col("n_repeat_words") * 100 > F.col("n_words") * 30)


def judge(rows: DataFrame, groups: list[str]) -> DataFrame:
    """``rows`` of measure() with ``base_failed`` and ``kept``."""
    named = [F.col(g).alias(f"_g{i}") for i, g in enumerate(groups)]
    # Written first: the join then meets a table of known size, or two shuffles of which a large group can be split.
    limits = written(cutoffs(rows, groups), fresh_folder(rows.sparkSession, "cutoffs")).select(*named, *[f"{m}_most" for m in MEASURES], *[f"{m}_least" for m, (_, low) in MEASURES.items() if low])
    met = [F.col(g).eqNullSafe(F.col(f"_g{i}")) for i, g in enumerate(groups)]
    joined = rows.join(limits, met, "left")
    broken = F.lit(False)
    for name, value in _values().items():
        broken = broken | (value > F.col(f"{name}_most"))
        if MEASURES[name][1]:
            broken = broken | (value < F.col(f"{name}_least"))
    return joined.withColumn("base_failed", base_failed()).withColumn("kept", ~F.col("base_failed") & ~F.coalesce(broken, F.lit(False))).select(*rows.columns, "base_failed", "kept")


def assess(docs: DataFrame, keep: list[str], groups: list[str], text: str = "text") -> DataFrame:
    """measure() and judge() over ``docs``. The counts are written once: thresholds and verdicts both read them."""
    names = list(dict.fromkeys([*keep, *groups]))
    rows = written(measure(docs, names, text), fresh_folder(docs.sparkSession, "measures"))
    return judge(rows, groups)
