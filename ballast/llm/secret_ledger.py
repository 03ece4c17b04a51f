"""Secret scan over a ledger of content-addressed blobs.

Every version of every path is named by the SHA-256 of its content. The ledger
holds, per blob, which rule versions have scanned it and what they found, so a run
scans only the (blob, rule version) pairs that no earlier run has, and each distinct
content once, however many paths carry it. Findings are joined back to all paths.

Nulls and empty contents are the blob of the empty text and have no findings.
Repeated rows are paths of the same blob and each gets the findings. Tables without
rows give results without rows. Columns beside the content pass through untouched.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ballast.functions.sizing import sized_broadcast, staged
from ballast.llm.shared import whole


@dataclass(frozen=True)
class Rule:
    """``least``: characters that group ``group`` of a match must have."""

    kind: str
    version: int
    pattern: str
    group: int = 0
    least: int = 1

    @property
    def name(self) -> str:
        return f"{self.kind}@{self.version}"


# Fixed by the contract, in the order of their kinds. A run of hexadecimal digits is
# matched from 32 on at once: shorter runs would be dropped and hide nothing.
BASE = (
    Rule(
        "assign",
        1,
        r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        group=2,
        least=8,
    ),
    Rule("access", 1, r"AKIA[A-Z0-9]+", least=16),
    Rule("hex", 1, r"[0-9a-f]{32,}", least=32),
)
# Public token formats beyond those.
MORE = (
    Rule("github", 1, r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("jwt", 1, r"eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
    Rule("private_key", 1, r"-----BEGIN [A-Z ]{0,40}PRIVATE KEY-----"),
)
RULES = BASE + MORE

LEDGER = (
    "blob_id string, rules array<string>, "
    "findings array<struct<rule:string,kind:string,start:bigint,end:bigint>>"
)
FINDINGS = "array<struct<rule:string,kind:string,start:bigint,end:bigint>>"


def blob_id(content: Column) -> Column:
    return F.sha2(whole(content).cast("binary"), 256)


def _found(text: Column, rule: Rule) -> Column:
    """Leftmost, non-overlapping matches with their places in code points."""
    pattern = F.lit(rule.pattern)
    sizes = F.zip_with(
        F.zip_with(
            F.split(text, rule.pattern, -1),
            F.regexp_extract_all(text, pattern, F.lit(0)),
            lambda gap, hit: F.struct(
                F.char_length(gap).alias("gap"), F.char_length(hit).alias("hit")
            ),
        ),
        F.regexp_extract_all(text, pattern, F.lit(rule.group)),
        lambda s, value: F.struct(
            s["gap"].alias("gap"), s["hit"].alias("hit"), F.char_length(value).alias("value")
        ),
    )

    def step(state: Column, s: Column) -> Column:
        start = state["at"] + s["gap"]
        end = start + F.coalesce(s["hit"], F.lit(0))
        span = F.struct(
            F.lit(rule.name).alias("rule"),
            F.lit(rule.kind).alias("kind"),
            start.alias("start"),
            end.alias("end"),
        )
        kept = s["value"] >= rule.least  # null after the last match
        return F.struct(
            end.alias("at"),
            F.when(kept, F.concat(state["spans"], F.array(span)))
            .otherwise(state["spans"])
            .alias("spans"),
        )

    begin = F.struct(
        F.lit(0).cast("bigint").alias("at"), F.array().cast(FINDINGS).alias("spans")
    )
    spans = F.aggregate(sizes, begin, step, lambda state: state["spans"])
    return F.when(text.rlike(rule.pattern), spans).otherwise(F.array().cast(FINDINGS))


def empty_ledger(like: DataFrame) -> DataFrame:
    return like.sparkSession.createDataFrame([], LEDGER)


def scan_unseen(
    versions: DataFrame,
    content: str,
    ledger: DataFrame | None = None,
    rules: Sequence[Rule] = RULES,
) -> DataFrame:
    """New ledger rows: a row per blob with a rule version that has not seen it.

    Equal contents are combined before and after the one exchange of texts. What the
    ledger holds in full is taken off by ids before that; the ids are broadcast if they
    are few enough, and meet the texts in a shuffle if not.
    """
    wanted = F.array(*[F.lit(r.name) for r in rules])
    named = versions.select(blob_id(F.col(content)).alias("blob_id"), whole(F.col(content)).alias("text"))
    if ledger is not None:
        seen_all = (
            ledger.select("blob_id", F.explode("rules").alias("rule"))
            .filter(F.col("rule").isin([r.name for r in rules]))
            .groupBy("blob_id")
            .agg(F.count_distinct("rule").alias("n"))
            .filter(F.col("n") == len(rules))
            .select("blob_id")
        )
        named = named.join(sized_broadcast(staged(seen_all, "seen")), "blob_id", "left_anti")
    blobs = named.groupBy("blob_id").agg(F.first("text").alias("text"))
    if ledger is None:
        todo = blobs.withColumn("todo", wanted)
    else:
        seen = (
            ledger.select("blob_id", F.explode("rules").alias("rule"))
            .groupBy("blob_id")
            .agg(F.collect_set("rule").alias("seen"))
        )
        todo = blobs.join(seen, "blob_id", "left").withColumn(
            "todo", F.array_except(wanted, F.coalesce("seen", F.array().cast("array<string>")))
        )
    nothing = F.array().cast(FINDINGS)
    found = [
        F.when(F.array_contains("todo", r.name), _found(F.col("text"), r)).otherwise(nothing)
        for r in rules
    ]
    return todo.filter(F.size("todo") > 0).select(
        "blob_id", F.col("todo").alias("rules"), F.concat(*found).alias("findings")
    )


def findings_by_path(
    versions: DataFrame, content: str, ledger: DataFrame, rules: Sequence[Rule] = RULES
) -> DataFrame:
    """Every row of ``versions`` without its content, with ``blob_id`` and the
    ``findings`` of the given rule versions, ordered by start and then by rule.

    What the ledger says of a blob is stored first: two plain inputs let Spark
    split a blob that very many paths share.
    """
    order = F.create_map(*[x for i, r in enumerate(rules) for x in (F.lit(r.name), F.lit(i))])
    names = [r.name for r in rules]
    # A ledger row that was appended twice counts once: the same finding of a blob is one.
    known = (
        ledger.filter(F.size("findings") > 0)
        .groupBy("blob_id")
        .agg(F.array_distinct(F.flatten(F.collect_set("findings"))).alias("findings"))
        .select(
            "blob_id",
            F.transform(
                F.sort_array(
                    F.transform(
                        F.filter("findings", lambda x: x["rule"].isin(names)),
                        lambda x: F.struct(
                            x["start"].alias("start"),
                            order[x["rule"]].alias("place"),
                            x["end"].alias("end"),
                            x["rule"].alias("rule"),
                            x["kind"].alias("kind"),
                        ),
                    )
                ),
                lambda x: F.struct(
                    x["rule"].alias("rule"),
                    x["kind"].alias("kind"),
                    x["start"].alias("start"),
                    x["end"].alias("end"),
                ),
            ).alias("findings"),
        )
    )
    kept = [c for c in versions.columns if c not in (content, "blob_id", "findings")]
    paths = versions.select(*kept, blob_id(F.col(content)).alias("blob_id"))
    return paths.join(staged(known, "findings"), "blob_id", "left").withColumn(
        "findings", F.coalesce("findings", F.array().cast(FINDINGS))
    )


def span_text(findings: Column) -> Column:
    """``kind:start:end`` of each finding, comma-joined."""
    return F.array_join(
        F.transform(findings, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ","
    )
