"""Secrets in document texts, scanned once per content and rule version."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from talkgrain.llm.common import let
from talkgrain.llm.spans import count, spans


@dataclass(frozen=True)
class Rule:
    """A pattern, and how long ``group`` of a match must be at least. Raise ``version`` with any
    change, so that contents scanned by the older rule are scanned again."""

    name: str
    pattern: str
    group: int = 0
    least: int = 1
    version: int = 1
    base: bool = False


# Fixed values. Starts are guarded and runs possessive, so that scanning takes linear time.
RULES = (
    Rule(
        "assign",
        r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        group=2,
        least=6,
        base=True,
    ),
    Rule("access", r"AKIA[A-Z0-9]++", least=20, base=True),
    Rule("hex", r"(?<![0-9a-f])[0-9a-f]{24,}+", least=24, base=True),
    Rule("private_key", r"-----BEGIN (?:[A-Z]+ )*+PRIVATE KEY-----"),
    Rule("code_host", r"(?<![A-Za-z0-9_])gh[oprsu]_[A-Za-z0-9]{36,}+"),
    Rule("chat", r"(?<![A-Za-z0-9-])xox[abprs]-[A-Za-z0-9-]{10,}+"),
    Rule("web_token", r"(?<![A-Za-z0-9_-])eyJ[A-Za-z0-9_-]{10,}+\.[A-Za-z0-9_-]{10,}+\.[A-Za-z0-9_-]{10,}+"),
)

_SPANS = "array<struct<start:bigint,end:bigint>>"
LEDGER = f"blob string, rule string, version int, spans {_SPANS}"


def content_address(text: Column) -> Column:
    return F.sha2(F.coalesce(text, F.lit("")), 256)


def _matches(text: Column, rule: Rule) -> Column:
    found = spans(text, rule.pattern, context=0)
    if rule.least > 1:
        found = F.filter(
            found,
            lambda s: F.length(
                F.regexp_extract(s["match"], rule.pattern, rule.group) if rule.group else s["match"]
            )
            >= rule.least,
        )
    return F.transform(found, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end")))


def scan_unseen(
    versions: DataFrame, ledger: str, text_col: str = "text", rules: tuple[Rule, ...] = RULES
) -> DataFrame:
    """Scan what the ledger lacks, add it to the ledger, and return the ledger.

    ``versions`` holds every version of every file, a text a row; equal texts are one blob, named
    by the SHA-256 of its content. ``ledger`` is the folder of a Parquet table with one row for
    each blob, rule and rule version scanned so far, made if absent. Pairs of blob and rule version
    that are in it are not scanned again. Blobs are made distinct by a grouped first value, folded
    in the scan tasks, so a content that a third of all files share is one row a task. One run at a
    time should add to a ledger: two would scan the same pairs and both write them, which changes no
    finding, for findings are sets.
    """
    spark = versions.sparkSession
    text = F.coalesce(F.col(text_col), F.lit(""))
    named = {
        r: F.struct(F.lit(r.name).alias("rule"), F.lit(r.version).alias("version")) for r in rules
    }
    wanted = F.array(*named.values())
    texts = versions.select(content_address(F.col(text_col)).alias("blob"), text.alias("_text"))
    missing = wanted
    before = _ledger(spark, ledger)
    if before is not None:
        seen = (
            before.groupBy("blob")
            .agg(F.collect_set(F.struct("rule", "version")).alias("_seen"))
        )
        # Only hashes are compared; a text that has been scanned in full is not shuffled for it.
        asked = texts.select("blob").distinct().join(seen, "blob", "left")
        todo = F.array_except(wanted, F.coalesce("_seen", F.slice(wanted, 1, 0))).alias("_todo")
        asked = asked.select("blob", todo).where(F.size("_todo") > 0)
        unseen = texts.join(asked, "blob").groupBy("blob")
        blobs = unseen.agg(F.first("_text").alias("_text"), F.first("_todo").alias("_todo"))
        missing = F.col("_todo")
    else:
        blobs = texts.groupBy("blob").agg(F.first("_text").alias("_text"))
    found = F.array(
        *(
            F.struct(
                F.lit(r.name).alias("rule"),
                F.lit(r.version).alias("version"),
                F.when(
                    F.array_contains(missing, name), _matches(F.col("_text"), r)
                ).alias("spans"),
            )
            for r, name in named.items()
        )
    )
    rows = blobs.select("blob", F.inline(found)).where(F.col("spans").isNotNull())
    rows.write.mode("append").parquet(ledger)
    return spark.read.schema(LEDGER).parquet(ledger)


def _ledger(spark: SparkSession, folder: str) -> DataFrame | None:
    try:
        return spark.read.schema(LEDGER).parquet(folder)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def find_secrets(
    docs: DataFrame,
    ledger: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    rules: tuple[Rule, ...] = RULES,
) -> DataFrame:
    """The secrets of each document, a row per row of ``docs``.

    Returns ``doc_id``, ``blob`` and ``spans``, an array of (start, order of the rule, rule, end)
    by start, then by rule. Findings are made per blob by ``scan_unseen`` and joined back to all
    documents that hold it. A null text counts as empty and has none, a long one is scanned whole, and
    rows that share an id or a text have what their text has. Other columns are not read.
    """
    order = F.create_map(*(F.lit(x) for i, r in enumerate(rules) for x in (r.name, i)))
    current = [(F.col("rule") == r.name) & (F.col("version") == r.version) for r in rules]
    anyone = current[0]
    for one in current[1:]:
        anyone = anyone | one
    hits = (
        scan_unseen(docs, ledger, text_col, rules)
        .where(anyone & (F.size("spans") > 0))
        .select("blob", order[F.col("rule")].alias("_order"), "rule", F.inline("spans"))
        .groupBy("blob")
        .agg(F.sort_array(F.collect_set(F.struct("start", "_order", "rule", "end"))).alias("spans"))
    )
    paths = docs.select(
        F.col(id_col).alias("doc_id"), content_address(F.col(text_col)).alias("blob")
    )
    empty = F.array().cast("array<struct<start:bigint,_order:int,rule:string,end:bigint>>")
    return paths.join(hits, "blob", "left").select(
        "doc_id", "blob", F.coalesce("spans", empty).alias("spans")
    )


def secrets_digest(found: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Counts and digests of ``find_secrets``: base rules counted and hashed, all spans as text."""
    names = [rule.name for rule in rules if rule.base]

    def listed(which: Column) -> Column:
        return F.array_join(
            F.transform(which, lambda s: F.concat_ws(":", s["rule"], s["start"], s["end"])), ","
        )

    def of(name: str) -> Column:
        return count(F.filter("spans", lambda s: s["rule"] == name))

    base = F.filter("spans", lambda s: s["rule"].isin(names))
    return found.select(
        "doc_id",
        *(of(name).alias(f"n_{name}") for name in names),
        F.sha2(listed(base), 256).alias("base_sha256"),
        listed(F.col("spans")).alias("spans"),
    )


def redacted(text: Column, found: Column, mark: str = "[secret]") -> Column:
    """A text with every stretch that its spans cover replaced by ``mark``."""

    def add(done: Column, span: Column) -> Column:
        apart = span["start"] > done["at"]
        gap = F.substr(text, (done["at"] + 1).cast("int"), (span["start"] - done["at"]).cast("int"))
        first = F.array_size(done["parts"]) == 0
        return F.struct(
            F.greatest(done["at"], span["end"]).alias("at"),
            F.when(apart | first, F.array_append(done["parts"], F.when(apart, gap).otherwise("")))
            .otherwise(done["parts"])
            .alias("parts"),
        )

    no_parts = F.array().cast("array<string>").alias("parts")
    begin = F.struct(F.lit(0).cast("long").alias("at"), no_parts)
    cut = F.aggregate(found, begin, add)
    whole = let(
        cut,
        lambda c: F.concat(
            F.array_join(F.concat(c["parts"], F.array(F.lit(""))), mark),
            F.substr(text, (c["at"] + 1).cast("int")),
        ),
    )
    return F.when(F.size(found) > 0, whole).otherwise(text)
