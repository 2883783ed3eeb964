"""Secret scans over a ledger of blobs: each content is scanned once per rule version, whatever paths hold it.

Every version of every path is named by the SHA-256 of its text. The ledger keeps two tables in a shared folder:
``scanned`` (blob, rule, rule version) and ``findings`` (the same plus start and end of each match). A scan
subtracts the ledger from the blobs at hand, reads one copy of each blob that has unseen rule versions, appends what
it finds, and joins the findings of all blobs back to every path. Only built-in functions run.

Defined cases: a null text is the empty text; a text without matches has a row without findings; repeated rows each
get the findings; null paths are paths like any other; offsets are code points, the end is exclusive. Columns other
than the path and text columns are not read, so their names cannot clash.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType
from pyspark.sql.window import Window

from adtrail.llm.store import written

@dataclass(frozen=True)
class Rule:
    """``pattern`` in Java syntax; a match counts if ``group`` has ``least`` characters or more.

    A changed pattern needs a new ``version``: the ledger then scans every blob again for that rule alone.
    ``probe``, if given, must match wherever the rule has a match that counts: most texts stop at it.
    """

    kind: str
    pattern: str
    group: int = 0
    least: int = 0
    version: int = 1
    probe: str | None = None

    @property
    def key(self) -> str:
        return f"{self.kind}@{self.version}"


def _any_case(word: str) -> str:
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in word)


_NAMES = "|".join([*map(_any_case, ("password", "passwd", "secret", "token")), _any_case("api") + "_?" + _any_case("key")])

#: Order matters: spans that start together are listed in it.
RULES = (
    Rule("assign", rf"""({_NAMES})["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 12, probe=rf"""({_NAMES})["']?\x20*[:=]\x20*["']?[A-Za-z0-9+/_.=-]{{12}}"""),
    # Runs are taken whole, so a least length in the pattern finds what a length check after ``+`` would.
    Rule("access", r"AKIA[A-Z0-9]{14,}"),
    Rule("hex", r"[0-9a-f]{16,}"),
    # The whole block: head, header lines, body (line ends may be spelled as in a JSON string) and the END line. Where
    # that is missing, all that can be body goes.
    Rule(
        "private_key",
        r"-----BEGIN [A-Z ]*PRIVATE KEY-----(?:[\t\n\r ]*[A-Za-z0-9-]+: [^\n]*\n){0,20}[A-Za-z0-9+/=\\\t\n\r ]*(?:-----END [A-Z ]*PRIVATE KEY-----)?",
        version=2,
    ),
    Rule("hosting_token", r"gh[pousr]_[A-Za-z0-9]{36,}", version=2),
    Rule("chat_token", r"xox[abprs]-[A-Za-z0-9-]{10,}", version=2),
    Rule("web_token", r"eyJ[A-Za-z0-9_-]{10,}\.eyJ[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}"),
)
BASE_KINDS = ("assign", "access", "hex")

_SCANNED = "blob_id string, rule string"
_FINDINGS = "blob_id string, rule string, kind string, start bigint, end bigint"


def _runs(text: Column, rule: Rule) -> Column:
    """An array of (code points before the match, code points of the match, whether it counts), in text order."""
    pattern = F.lit(rule.pattern)
    whole = F.regexp_extract_all(text, pattern, F.lit(0))
    judged = whole if rule.group == 0 else F.regexp_extract_all(text, pattern, F.lit(rule.group))
    runs = F.transform(
        F.arrays_zip(F.slice(F.split(text, rule.pattern, -1), F.lit(1), F.size(whole)).alias("gap"), whole.alias("hit"), judged.alias("judged")),
        lambda r: F.struct(
            F.char_length(r["gap"]).cast("long").alias("gap"),
            F.char_length(r["hit"]).cast("long").alias("hit"),
            (F.char_length(r["judged"]) >= rule.least).alias("counts"),
        ),
    )
    return F.when(text.rlike(rule.probe or rule.pattern), runs)


def find_spans(texts: DataFrame, key: str, text: str, wanted: str, rules: tuple[Rule, ...]) -> DataFrame:
    """(key, rule, kind, start, end) of the matches in one row per key; ``wanted`` holds the rule keys to apply.

    Positions are running sums over the pieces between matches, so a text with many matches costs in proportion.
    Rows that are there twice give the same pieces, which count once.
    """
    per_rule = F.array(*[
        F.struct(
            F.lit(r.key).alias("rule"),
            F.lit(r.kind).alias("kind"),
            F.when(F.array_contains(wanted, r.key), _runs(F.col(text), r)).alias("runs"),
        )
        for r in rules
    ])
    found = texts.select(key, F.explode(F.filter(per_rule, lambda r: F.size(r["runs"]) > 0)).alias("r"))
    pieces = found.select(key, "r.rule", "r.kind", F.posexplode("r.runs").alias("i", "run")).select(key, "rule", "kind", "i", "run.*")
    pieces = pieces.repartition(key, "rule").distinct()  # one shuffle serves this and the window
    upto = F.sum(F.col("gap") + F.col("hit")).over(Window.partitionBy(key, "rule").orderBy("i"))
    spans = pieces.withColumn("end", upto).where("counts")
    return spans.select(key, "rule", "kind", (F.col("end") - F.col("hit")).alias("start"), "end")


class BlobLedger:
    """The ledger in ``folder``, a path that driver and executors share."""

    def __init__(self, spark: SparkSession, folder: str, rules: tuple[Rule, ...] = RULES):
        self.spark, self.folder, self.rules = spark, folder.rstrip("/"), rules

    def _table(self, name: str, schema: str) -> DataFrame:
        try:
            return self.spark.read.schema(schema).parquet(f"{self.folder}/{name}")
        except AnalysisException as error:
            if "PATH_NOT_FOUND" not in str(error):
                raise
            return self.spark.range(0).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in StructType.fromDDL(schema)])

    def scanned(self) -> DataFrame:
        return self._table("scanned", _SCANNED).distinct()

    def findings(self) -> DataFrame:
        """Of the current rule versions. A run that broke off may have left rows twice; they count once."""
        keys = [r.key for r in self.rules]
        return self._table("findings", _FINDINGS).where(F.col("rule").isin(keys)).distinct()

    def scan(self, versions: DataFrame, path: list[str], text: str = "text") -> DataFrame:
        """Bring the ledger up to date for ``versions`` and return (path columns, blob_id), one row per input row."""
        held = versions.select(*path, F.coalesce(F.col(text), F.lit("")).alias("_text"))
        held = held.withColumn("_blob", F.sha2("_text", 256))
        seen = self.scanned().groupBy("blob_id").agg(F.collect_set("rule").alias("_seen"))  # at most one entry per rule
        every = F.array(*[F.lit(r.key) for r in self.rules])
        blobs = held.groupBy("_blob").agg(F.min(F.struct(*path)).alias("_at"))
        run = f"{self.folder}/pending-{uuid.uuid4().hex}"
        unseen = written(
            blobs.join(seen.withColumnRenamed("blob_id", "_blob"), "_blob", "left")
            .withColumn("_wanted", F.array_except(every, F.coalesce("_seen", F.array().cast("array<string>"))))
            .where(F.size("_wanted") > 0)
            .select(F.col("_blob").alias("_b"), "_at", "_wanted"),
            run,
        )
        # One copy of each such blob, met by its content and one of its paths: no key is shared by many rows.
        # The small side is the one that is hashed; texts stream past it unsorted.
        met = reduce(lambda a, b: a & b, [F.col("_blob") == F.col("_b"), *[F.col(c).eqNullSafe(F.col("_at")[c]) for c in path]])
        todo = held.join(unseen.hint("shuffle_hash"), met).select(F.col("_blob").alias("blob_id"), "_text", "_wanted")
        self._append(find_spans(todo, "blob_id", "_text", "_wanted", self.rules), "findings")
        self._append(unseen.select(F.col("_b").alias("blob_id"), F.explode("_wanted").alias("rule")), "scanned")
        return held.select(*path, F.col("_blob").alias("blob_id"))

    def _append(self, df: DataFrame, name: str) -> None:
        df.write.mode("append").parquet(f"{self.folder}/{name}")


def listed(findings: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Per blob: its spans in order (start, then rule order). Bounded by what one text can hold."""
    order = F.create_map(*[x for i, r in enumerate(rules) for x in (F.lit(r.kind), F.lit(i))])
    return findings.groupBy("blob_id").agg(
        F.sort_array(F.collect_list(F.struct("start", order[F.col("kind")].alias("rank"), "kind", "end"))).alias("spans")
    )


def scan_paths(spark: SparkSession, versions: DataFrame, path: list[str], text: str, folder: str, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """(path columns, blob_id, spans) for every row of ``versions``; spans is null where nothing was found."""
    ledger = BlobLedger(spark, folder, rules)
    paths = ledger.scan(versions, path, text)
    # Written first: the join then meets two shuffles, and a blob that many paths hold can be split.
    found = written(listed(ledger.findings(), rules), f"{ledger.folder}/listed-{uuid.uuid4().hex}")
    return paths.join(found, "blob_id", "left").select(*path, "blob_id", "spans")


def redact(text: Column, spans: Column, mask: str = "[REDACTED]") -> Column:
    """The text with every span replaced by ``mask``; overlapping spans are replaced together, by one mask."""
    start = F.struct(F.lit("").alias("out"), F.lit(0).cast("long").alias("at"))

    def step(done, span):
        gap = F.substring(text, (done["at"] + 1).cast("int"), (span["start"] - done["at"]).cast("int"))
        grown = F.when(span["start"] >= done["at"], F.concat(done["out"], gap, F.lit(mask))).otherwise(done["out"])
        return F.struct(grown.alias("out"), F.greatest(done["at"], span["end"]).alias("at"))

    rest = lambda done: F.concat(done["out"], F.substring(text, (done["at"] + 1).cast("int"), F.char_length(text)))
    return F.when(F.size(spans) > 0, F.aggregate(spans, start, step, rest)).otherwise(text)
