"""

The tables stand in for a transcript collection. ``conversations`` are utterances (``conv_id``
is the transcript, ``role`` the speaker, ``turn`` order and time). ``documents`` are transcripts
of a corpus (``source``) whose lines are utterances of a speaker (``lang``).
"""

from __future__ import annotations

import os
import sys
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import talkgrain as tg  # noqa: E402
from talkgrain import plans  # noqa: E402
from talkgrain.sources.shared import shared_folder  # noqa: E402

try:
    from talkgrain.llm import queries as llm  # noqa: E402
except ImportError:  # the subpackage may be left out
    llm = None
try:
    import corpus_pipeline  # noqa: E402
except ImportError:
    corpus_pipeline = None

Query = Callable[[SparkSession, str], DataFrame]

# ---------------------------------------------------------------- views of the given tables


# Stated, so that no job runs to infer them.
_DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"
# The transcripts of a release, with a time of their own: their length stands in for an age.
_TRANSCRIPTS = "transcript_id long, corpus string, collection string, n_chars long"
_CONVERSATIONS = "conv_id long, turn long, role string, text string"

# The measures cut text into words, which is worth spreading over all cores first; a filter, a
# line count or a copy of the rows is not.


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.schema(_DOCUMENTS).parquet(f"{sf_dir}/documents.parquet")


def _lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tg.lines_as_utterances(_documents(spark, sf_dir))


def _spread_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tg.lines_as_utterances(tg.spread(_documents(spark, sf_dir), ["doc_id"]))


def _utterances(spark: SparkSession, sf_dir: str) -> DataFrame:
    conversations = spark.read.schema(_CONVERSATIONS).parquet(f"{sf_dir}/conversations.parquet")
    return conversations.select(
        F.col("conv_id").alias("transcript_id"),
        F.col("turn").alias("utterance_order"),
        F.col("role").alias("speaker"),
        "text",
    )


def _spread_utterances(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tg.spread(_utterances(spark, sf_dir), ["transcript_id", "utterance_order"])


def _transcripts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _documents(spark, sf_dir).select(
        F.col("doc_id").alias("transcript_id"), F.col("source").alias("corpus")
    )


# ------------------------------------------- tables that Spark derives and writes for itself

_written: dict[tuple[str, str, str], str] = {}


def _once(spark: SparkSession, sf_dir: str, name: str, write: Callable[[str], None]) -> str:
    """The folder of a derived table, written the first time an application asks for it."""
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _written:
        folder = shared_folder(spark, name)
        write(folder)
        _written[key] = folder
    return _written[key]


def _release_store(spark: SparkSession, sf_dir: str) -> str:
    """Three releases of ``documents`` on Parquet, and their manifest.

    The first has the English transcripts, the second all but the French, the third all of
    them, with a phonological transcription (stood in for by the lower-cased text).
    """

    def write(base: str) -> None:
        # The table may come as one piece: it is dealt out once, so that each task sorts and cuts a
        # bounded part of it, and by doc_id, for dealing in turn would sort that piece in memory.
        dealt = f"{base}/dealt"
        tg.spread(_documents(spark, sf_dir), ["doc_id"]).write.option("compression", "zstd").parquet(dealt)
        documents = spark.read.schema(_DOCUMENTS).parquet(dealt)
        # Documents are sorted, and not their lines and words, which come in the same order.
        lines = tg.lines_as_utterances(documents.sortWithinPartitions("source", "lang"))
        transcripts = documents.select(
            F.col("doc_id").alias("transcript_id"),
            F.col("source").alias("corpus"),
            F.lit("main").alias("collection"),
            "n_chars",
            "lang",
        )
        english, not_french = "{} = 'en'", "{} <> 'fr'"
        for release, kept in (("2018.1", english), ("2019.1", not_french), ("2020.1", None)):
            utterances = lines.where(kept.format("speaker")) if kept else lines
            if kept is None:
                utterances = utterances.withColumn("phonology", F.lower("text"))
            members = transcripts.where(kept.format("lang")) if kept else transcripts
            tg.write_release(utterances, base, "utterances", release, arranged=True)
            tg.write_release(members.drop("lang"), base, "transcripts", release, _TRANSCRIPTS)
        tg.write_release(tg.tokens(lines), base, "tokens", "2020.1", arranged=True)
        corpora = transcripts.select("corpus", "collection").distinct()
        tg.write_release(corpora, base, "corpora", "2020.1")
        tg.write_manifest(spark, f"{base}/manifest.json", ["2018.1", "2019.1", "2020.1"], "2020.1")

    return _once(spark, sf_dir, "releases", write)


def _transcript_files(spark: SparkSession, sf_dir: str) -> str:
    """``conversations`` as XML, with the text of each utterance and its word elements."""

    def write(folder: str) -> None:
        # Words are what stands between spaces, each with a number and an annotation inside it.
        split = F.array_remove(F.split("text", " "), "")
        annotation = F.struct(F.lit("mor").alias("_type"), F.lit("n").alias("_VALUE"))

        def element(word, position):
            return F.struct(word.alias("_VALUE"), position.alias("_n"), annotation.alias("mor"))

        _spread_utterances(spark, sf_dir).select(
            F.col("transcript_id").alias("_transcript"),
            F.col("utterance_order").alias("_order"),
            F.col("speaker").alias("_who"),
            "text",
            F.transform(split, element).alias("w"),
        ).write.format("xml").option("rootTag", "transcripts").option("rowTag", "u").save(folder)

    return _once(spark, sf_dir, "transcripts-xml", write)


def _layout(text: str | None = None, words: str | None = None) -> tg.TranscriptLayout:
    word = T.StructType(
        [
            T.StructField("_VALUE", T.StringType()),
            T.StructField("_n", T.LongType()),
            T.StructField("mor", T.StructType([T.StructField("_VALUE", T.StringType())])),
        ]
    )
    return tg.TranscriptLayout(
        row_tag="u",
        schema=T.StructType(
            [
                T.StructField("_transcript", T.LongType()),
                T.StructField("_order", T.LongType()),
                T.StructField("_who", T.StringType()),
                T.StructField("text", T.StringType()),
                T.StructField("w", T.ArrayType(word)),
            ]
        ),
        transcript_id="_transcript",
        order="_order",
        speaker="_who",
        text=text,
        words=words,
        word="_VALUE" if words else None,
    )


# ------------------------------------------------------------------------------- queries


def _tokenize(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Arrays are shown as text, for the comparison with SQL.
    return tg.tokenize(_spread_utterances(spark, sf_dir)).withColumn("words", F.array_join("words", " "))


def _read_current(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tg.read_release(spark, _release_store(spark, sf_dir), "utterances")


def _read_named(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tg.read_release(spark, _release_store(spark, sf_dir), "utterances", "2019.1")


def _stamp_release(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tg.stamp_release(tg.mlu_w(_spread_lines(spark, sf_dir)), "2020.1")


def _union_releases(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = _release_store(spark, sf_dir)
    before_phonology = [
        tg.read_release(spark, base, "utterances", release).drop("phonology")
        for release in ("2018.1", "2019.1")
    ]
    return tg.union_releases([*before_phonology, _read_current(spark, sf_dir)])


def _compared(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """Old: all but the French. New: without src3, src5 moved, lines joined in the text."""
    transcripts = _documents(spark, sf_dir).select(
        F.col("source").alias("corpus"), F.col("doc_id").alias("transcript_id"), "text", "lang"
    )
    old = transcripts.where("lang <> 'fr'").withColumn("collection", F.lit("main"))
    new = (
        transcripts.where("corpus <> 'src3'")
        .withColumn("text", F.replace("text", F.lit("\n"), F.lit(" ")))
        .withColumn(
            "collection", F.when(F.col("corpus") == "src5", "phonological").otherwise("main")
        )
    )
    columns = ["corpus", "transcript_id", "collection", "text"]
    return {"1": old.select(columns), "2": new.select(columns)}


def _compare_releases(
    spark: SparkSession, sf_dir: str, unique_keys: bool = False
) -> DataFrame:
    releases = _compared(spark, sf_dir)
    old, new = releases["1"], releases["2"]
    keys, attrs = ["corpus", "transcript_id"], ["collection", "text"]
    return tg.compare_releases(
        old, new, keys, attrs, digests=["text"], unique_keys=unique_keys
    )


def _load_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each supported release with the size of its snapshot."""
    base = _release_store(spark, sf_dir)
    sizes = (
        tg.read_releases(spark, base, "utterances")
        .groupBy("release")
        .agg(F.count(F.lit(1)).alias("n_utterances"))
    )
    return tg.load_manifest(spark, f"{base}/manifest.json").join(sizes, "release")


def _resolve_release(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The current release and a named one, each with its own counts."""
    base = _release_store(spark, sf_dir)
    manifest = tg.load_manifest(spark, f"{base}/manifest.json")
    counts = []
    for version in (None, "2018.1"):
        release = tg.resolve_release(manifest, version)
        utterances = tg.read_release(spark, base, "utterances", release)
        counts.append(
            tg.stamp_release(tg.population_utterances(utterances, ["speaker"]), release)
        )
    return tg.union_releases(counts)


def _mirror_release(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = _release_store(spark, sf_dir)

    def write(out: str) -> None:
        def source(table: str, release: str) -> DataFrame:
            return tg.read_release(spark, base, table, release)

        tables = ["transcripts", "utterances"]
        tg.mirror_store(spark, source, tables, ["2019.1", "2020.1"], "2020.1", out)

    out = _once(spark, sf_dir, "mirror", write)
    utterances = tg.read_release(spark, out, "utterances").drop("release")
    return tg.with_corpus(utterances, tg.read_release(spark, out, "transcripts"))


def _ingest_transcripts(spark: SparkSession, sf_dir: str, split_files: bool = False) -> DataFrame:
    files = _transcript_files(spark, sf_dir)
    return tg.ingest_transcripts(spark, files, _layout(text="text"), split_files)


def _ingest_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = _transcript_files(spark, sf_dir)
    return tg.tokens(tg.ingest_transcripts(spark, files, _layout(words="w")))


def _collection_files(spark: SparkSession, sf_dir: str) -> str:
    """``conversations`` as one XML tree of transcripts that are named by a text.

    Each has a corpus and a bank, its participants, and utterances with a phonological
    transcription (stood in for by the lower-cased text).
    """

    def write(folder: str) -> None:
        utterance = F.struct(
            "utterance_order", F.col("speaker").alias("_who"), "text", F.lower("text").alias("pho")
        )
        who = F.struct(F.col("speaker").alias("_id"), F.concat(F.lit("a "), "speaker").alias("_role"))
        corpus = F.col("transcript_id") % 4
        _utterances(spark, sf_dir).groupBy("transcript_id").agg(
            F.sort_array(F.collect_set(who)).alias("participant"),
            F.sort_array(F.collect_list(utterance)).alias("u"),
        ).select(
            F.concat(F.lit("conv-"), "transcript_id").alias("_id"),
            F.concat(F.lit("c"), corpus).alias("_corpus"),
            F.when(corpus == 3, "phon").otherwise("main").alias("_bank"),
            "participant",
            "u",
        ).write.format("xml").option("rootTag", "bank").option("rowTag", "transcript").save(folder)

    return _once(spark, sf_dir, "collection-xml", write)


def _collection(spark: SparkSession, sf_dir: str) -> tg.Collection:
    layout = tg.CollectionLayout(
        row_tag="transcript",
        schema=T.StructType.fromDDL(
            "_id string, _corpus string, _bank string, "
            "participant array<struct<_id: string, _role: string>>, "
            "u array<struct<_who: string, text: string, pho: string>>"
        ),
        transcript_id="_id",
        utterances="u",
        speaker="_who",
        text="text",
        phonology="pho",
        corpus="_corpus",
        collection="_bank",
        participants="participant",
        participant="_id",
        role="_role",
    )
    return tg.ingest_collection(spark, _collection_files(spark, sf_dir), layout)


def _match_transcripts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Half of the ids are new, one in seven transcripts is gone, one in five has another first line."""
    old = _lines(spark, sf_dir)
    number, first = F.col("transcript_id"), F.col("utterance_order") == 1
    revised = F.concat("text", F.lit(" (revised)"))
    new = old.where(number % 7 != 3).withColumns(
        {
            "transcript_id": F.when(number % 2 == 0, number + 1_000_000).otherwise(number),
            "text": F.when(first & (number % 5 == 1), revised).otherwise(F.col("text")),
        }
    )
    return tg.match_transcripts(old, new)


def _compare_utterances(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines that are told apart by a number; in three transcripts of four some go, come, change,
    and the second moves to the end."""
    order = F.col("utterance_order")
    old = _lines(spark, sf_dir).withColumn("text", F.concat(order, F.lit(" "), "text"))
    length = old.groupBy("transcript_id").agg(F.max("utterance_order").alias("n"))
    counted = old.join(length, "transcript_id")
    untouched = F.col("transcript_id") % 4 == 0
    edited = counted.where(~untouched & (order % 10 != 3))
    text = F.when(order % 10 == 7, F.concat("text", F.lit(" (revised)"))).otherwise(F.col("text"))
    place = F.when((order == 2) & (F.col("n") >= 8), 2 * F.col("n") + 2).otherwise(2 * order)
    added = counted.where(~untouched & (order % 10 == 0)).withColumns(
        {"text": F.concat(F.lit("new after "), order), "utterance_order": 2 * order + 1}
    )
    new = (
        counted.where(untouched)
        .unionByName(edited.withColumns({"text": text, "utterance_order": place}))
        .unionByName(added)
    )
    return tg.compare_utterances(old, new.drop("n"))


def _mirror_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Utterances copied by ranges of their transcript, and read from the copy."""
    base = _release_store(spark, sf_dir)

    def write(out: str) -> None:
        def source(low: int | None, high: int | None) -> DataFrame:
            rows, key = tg.read_release(spark, base, "utterances"), F.col("transcript_id")
            rows = rows.where(key >= low) if low is not None else rows
            # The range without a start holds the rows without a key.
            inside = key.isNull() | (key < high) if low is None and high is not None else key < high
            return rows.where(inside) if high is not None else rows

        tg.mirror_ranges(spark, source, "utterances", "2020.1", [100, 500, 700], out)
        tg.write_manifest(spark, f"{out}/manifest.json", ["2020.1"], "2020.1")

    return tg.read_release(spark, _once(spark, sf_dir, "mirror-ranges", write), "utterances")


def _differing_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A copy with one text changed, one row lost and another repeated in its place."""
    rows = _documents(spark, sf_dir).select("doc_id", "text", "source")
    key = F.col("doc_id")
    copy = rows.where(key != 250).withColumn("text", F.when(key == 30, "x").otherwise(F.col("text")))
    return tg.differing_ranges(rows, copy.unionByName(rows.where(key == 270)), "doc_id", 100)


def _union_widened(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three releases whose ids are LONG, DECIMAL and INT, and whose last column changed to text."""
    transcripts = _documents(spark, sf_dir).select("doc_id", "lang", "n_chars")
    number = F.col("doc_id")
    releases = [
        transcripts.where("lang = 'en'"),
        transcripts.where("lang <> 'fr'").withColumn("doc_id", number.cast("decimal(12,0)")),
        transcripts.withColumns(
            {"doc_id": number.cast("int"), "n_chars": F.concat("n_chars", F.lit(" characters"))}
        ),
    ]
    stacked = tg.union_releases(releases, widen=True)
    # Decimals are shown as text, for the comparison with SQL.
    return stacked.withColumn("doc_id", F.col("doc_id").cast("string"))


def _bucketed(spark: SparkSession, sf_dir: str) -> str:
    """The utterances of one release and the transcripts of two, by transcript; gives their prefix."""
    name = f"b{abs(hash(sf_dir)):x}_"

    def write(base: str) -> None:
        lines, transcripts = _lines(spark, sf_dir), _transcripts(spark, sf_dir)
        for release, rows in _compared(spark, sf_dir).items():
            schema = "transcript_id long, collection string, text string"
            tg.write_bucketed(rows, base, "texts", release, 8, schema=schema, prefix=name)
        tg.write_bucketed(lines.drop("corpus"), base, "utterances", "2", 8, prefix=name)
        tg.write_bucketed(transcripts, base, "transcripts", "2", 8, prefix=name)

    _once(spark, sf_dir, "bucketed", write)
    return name


def _with_corpus_bucketed(spark: SparkSession, sf_dir: str) -> DataFrame:
    prefix = _bucketed(spark, sf_dir)
    utterances, transcripts = (
        tg.bucketed_table(spark, table, "2", prefix).drop("release") for table in ("utterances", "transcripts")
    )
    return tg.with_corpus(utterances.drop("phonology"), transcripts)


def _compare_bucketed(spark: SparkSession, sf_dir: str) -> DataFrame:
    prefix = _bucketed(spark, sf_dir)
    old, new = (tg.bucketed_table(spark, "texts", release, prefix) for release in "12")
    return tg.compare_releases(
        old, new, ["transcript_id"], ["collection", "text"], unique_keys=True, co_located=True
    )


def _sql(query: str) -> Query:
    """A query in SQL over the releases."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        base = _release_store(spark, sf_dir)
        tg.register_sql(spark, base, "talk_")
        return spark.sql(query)

    return run


def _estimated_ttr(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether the estimate from stored sketches is within 5 % of the exact ratio, by speaker."""
    lines = _spread_lines(spark, sf_dir)
    sketches = tg.type_sketches(lines)
    estimated = tg.estimated_type_token_ratio(sketches).withColumnRenamed("ttr", "estimate")
    exact = tg.type_token_ratio(lines).select(F.col("speaker").alias("s"), "ttr")
    joined = estimated.join(exact, F.col("speaker").eqNullSafe(F.col("s")))
    near = F.abs(F.col("estimate") / F.col("ttr") - 1) <= 0.05
    return joined.select("speaker", "n_tokens", near.alias("is_near"))


def _corpus_conflicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of one corpus in three that are stored under the name of the next one."""
    number = F.regexp_extract("corpus", r"(\d+)", 1).cast("long")
    wrong = (number % 3 == 0) & (F.col("utterance_order") % 2 == 0)
    stored = F.when(wrong, F.concat(F.lit("src"), number + 1)).otherwise(F.col("corpus"))
    lines = _lines(spark, sf_dir).withColumn("corpus", stored)
    return tg.corpus_conflicts(lines, _transcripts(spark, sf_dir))


_STATE_BY = ("corpus", "speaker")
_DIGESTS = "transcript_id long, n_rows long, content string"
_SIZES = "corpus string, speaker string, n_all long, n_utterances long, n_tokens long"
_WORD_COUNTS = "corpus string, speaker string, word string, n long"


def _measured_store(spark: SparkSession, sf_dir: str) -> str:
    """Two releases with the digests of their transcripts, and the state of the first.

    The first has four documents of five, one in seven of them in capitals; the second has two of
    three, so that transcripts are added, removed and revised.
    """

    def write(base: str) -> None:
        lines, number = _lines(spark, sf_dir), F.col("transcript_id")
        text = F.when(number % 7 == 0, F.upper("text")).otherwise(F.col("text"))
        releases = {
            "2019.1": lines.where(number % 5 != 0).withColumn("text", text),
            "2020.1": lines.where(number % 3 != 0),
        }
        for release, utterances in releases.items():
            tg.write_release(utterances, base, "utterances", release)
            stored = tg.release_table(spark, base, "utterances", release)
            digests = tg.transcript_digests(stored, ["corpus", "speaker", "text"])
            tg.write_release(digests, base, "digests", release, _DIGESTS)
        state = tg.measure_state(tg.release_table(spark, base, "utterances", "2019.1"), _STATE_BY)
        tg.write_release(state.sizes, base, "sizes", "2019.1", _SIZES)
        tg.write_release(state.words, base, "words", "2019.1", _WORD_COUNTS)

    return _once(spark, sf_dir, "measured", write)


def _updated_state(spark: SparkSession, sf_dir: str) -> tg.MeasureState:
    """The state of the second release from that of the first and the transcripts that changed."""
    base = _measured_store(spark, sf_dir)

    def table(name: str, release: str, schema: str | None = None) -> DataFrame:
        return tg.release_table(spark, base, name, release, schema).drop("release")

    old, new = (table("utterances", release) for release in ("2019.1", "2020.1"))
    changed = tg.changed_transcripts(
        table("digests", "2019.1", _DIGESTS), table("digests", "2020.1", _DIGESTS)
    )
    stored = tg.MeasureState(
        _STATE_BY, table("sizes", "2019.1", _SIZES), table("words", "2019.1", _WORD_COUNTS)
    )
    return tg.updated_state(stored, old, new, changed)


def entry(spark: SparkSession) -> DataFrame:
    return tg.mlu_w(_spread_utterances(spark, "/root/testdata/sf0.001"))


def queries() -> dict[str, Query]:
    found = _own_queries()
    if llm is not None:
        found |= llm.queries()
    if corpus_pipeline is not None:
        found["pipeline"] = corpus_pipeline.run
    return found


def oracle_sql() -> dict[str, str]:
    found = _own_oracle_sql()
    if llm is not None:
        found |= llm.oracle_sql()
    if corpus_pipeline is not None and corpus_pipeline.ORACLE_SQL:
        found["pipeline"] = corpus_pipeline.ORACLE_SQL
    return found


def _own_queries() -> dict[str, Query]:
    return {
        # Measures by speaker, on conversations.
        "word_frequency": lambda s, d: tg.word_frequency(_spread_utterances(s, d)),
        "mlu_w": lambda s, d: tg.mlu_w(_spread_utterances(s, d)),
        "type_token_ratio": lambda s, d: tg.type_token_ratio(_spread_utterances(s, d)),
        "growth_curve_mlu": lambda s, d: tg.growth_curve(
            _spread_utterances(s, d), "mlu_w", "utterance_order"
        ),
        "growth_curve_ttr": lambda s, d: tg.growth_curve(
            _spread_utterances(s, d), "ttr", "utterance_order", bin_width=2
        ),
        # The same by corpus and speaker, on the lines of all documents.
        "word_frequency_by_corpus": lambda s, d: tg.word_frequency(
            _spread_lines(s, d), ["corpus", "speaker"]
        ),
        "mlu_w_by_corpus": lambda s, d: tg.mlu_w(_spread_lines(s, d), ["corpus", "speaker"]),
        "type_token_ratio_by_corpus": lambda s, d: tg.type_token_ratio(
            _spread_lines(s, d), ["corpus", "speaker"]
        ),
        "population_utterances": lambda s, d: tg.population_utterances(_lines(s, d)),
        "population_tokens": lambda s, d: tg.population_tokens(_spread_lines(s, d)),
        "population": lambda s, d: tg.population(
            _spread_lines(s, d).drop("corpus"), _transcripts(s, d)
        ),
        "growth_curve_mlu_lines": lambda s, d: tg.growth_curve(
            _spread_lines(s, d), "mlu_w", "utterance_order", bin_width=10
        ),
        "growth_curve_ttr_lines": lambda s, d: tg.growth_curve(
            _spread_lines(s, d), "ttr", "utterance_order", bin_width=10
        ),
        # Rows.
        "tokenize": _tokenize,
        "tokens": lambda s, d: tg.tokens(_spread_utterances(s, d)),
        "lines_as_utterances": _lines,
        "with_corpus": lambda s, d: tg.with_corpus(
            _lines(s, d).drop("corpus"), _transcripts(s, d)
        ),
        "with_corpus_salted": lambda s, d: tg.with_corpus(
            _lines(s, d).drop("corpus"), _transcripts(s, d), salts=8
        ),
        "for_speakers": lambda s, d: tg.for_speakers(_utterances(s, d), ["user", "system"]),
        "for_corpora": lambda s, d: tg.for_corpora(_lines(s, d), ["src1", "src12"]),
        # Releases.
        "read_release": _read_current,
        "read_release_named": _read_named,
        "stamp_release": _stamp_release,
        "union_releases": _union_releases,
        "compare_releases": _compare_releases,
        "compare_releases_unique": lambda s, d: _compare_releases(s, d, unique_keys=True),
        "read_release_tokens": lambda s, d: tg.read_release(s, _release_store(s, d), "tokens"),
        "read_release_corpora": lambda s, d: tg.read_release(s, _release_store(s, d), "corpora"),
        "word_frequency_stored_tokens": lambda s, d: tg.word_frequency(
            tg.read_release(s, _release_store(s, d), "tokens"), ["corpus", "speaker"]
        ),
        "load_manifest": _load_manifest,
        "resolve_release": _resolve_release,
        "mirror_release": _mirror_release,
        "ingest_transcripts": _ingest_transcripts,
        "ingest_transcripts_split": lambda s, d: _ingest_transcripts(s, d, split_files=True),
        "ingest_tokens": _ingest_tokens,
        # A collection from files: five tables with ids that every run gives alike.
        "ingest_corpora": lambda s, d: _collection(s, d).corpora,
        "ingest_transcript_table": lambda s, d: _collection(s, d).transcripts,
        "ingest_participants": lambda s, d: _collection(s, d).participants,
        "ingest_collection_utterances": lambda s, d: _collection(s, d).utterances,
        "ingest_collection_tokens": lambda s, d: _collection(s, d).tokens,
        # What became of transcripts and of their utterances.
        "match_transcripts": _match_transcripts,
        "compare_utterances": _compare_utterances,
        # Measures of a release from those of the one before and what changed.
        "word_frequency_delta": lambda s, d: tg.state_frequency(_updated_state(s, d)),
        "mlu_w_delta": lambda s, d: tg.state_mlu_w(_updated_state(s, d)),
        "type_token_ratio_delta": lambda s, d: tg.state_type_token_ratio(_updated_state(s, d)),
        "population_delta": lambda s, d: tg.state_population(_updated_state(s, d)),
        # Laid out by transcript: no shuffle.
        "with_corpus_bucketed": _with_corpus_bucketed,
        "compare_releases_bucketed": _compare_bucketed,
        # Copies that are proven, and releases whose types changed.
        "mirror_ranges": _mirror_ranges,
        "differing_ranges": _differing_ranges,
        "union_releases_widened": _union_widened,
        "corpus_conflicts": _corpus_conflicts,
        # The measures in SQL.
        "sql_word_frequency": _sql("SELECT * FROM talk_word_frequency('2019.1', array('de', 'en'))"),
        "sql_mlu_w": _sql("SELECT * FROM talk_mlu_w()"),
        "sql_type_token_ratio": _sql("SELECT * FROM talk_type_token_ratio(version => '2018.1')"),
        "sql_population": _sql(
            "SELECT * FROM talk_population(corpora => array('src0', 'src7')) WHERE n_tokens > 100"
        ),
        "estimated_type_token_ratio": _estimated_ttr,
        # Lexical diversity in windows of equal length.
        "moving_type_token_ratio": lambda s, d: tg.moving_type_token_ratio(
            _spread_lines(s, d), window=50
        ),
        "moving_type_token_ratio_by_corpus": lambda s, d: tg.moving_type_token_ratio(
            _spread_lines(s, d), window=20, by=["corpus", "speaker"]
        ),
        # The three analyses, from a release to a stamped result.
        "analysis_frequency": lambda s, d: plans.frequency(
            s, _release_store(s, d), corpora=["src0", "src7"], spread_scan=True
        ),
        "analysis_frequency_all": lambda s, d: plans.frequency(
            s, _release_store(s, d), spread_scan=True
        ),
        "analysis_derived_measures": lambda s, d: plans.derived_measures(
            s,
            _release_store(s, d),
            "mlu_w",
            bin_width=5,
            speakers=["de", "en"],
            version="2019.1",
            spread_scan=True,
        ),
        "analysis_growth_all": lambda s, d: plans.derived_measures(
            s, _release_store(s, d), "ttr", bin_width=5, spread_scan=True
        ),
        "analysis_growth_by_transcript": lambda s, d: plans.derived_measures(
            s,
            _release_store(s, d),
            "mlu_w",
            "n_chars",
            bin_width=1000,
            spread_scan=True,
            transcripts_schema=_TRANSCRIPTS,
        ),
        "analysis_growth_ttr_by_transcript": lambda s, d: plans.derived_measures(
            s,
            _release_store(s, d),
            "ttr",
            "n_chars",
            bin_width=1000,
            spread_scan=True,
            transcripts_schema=_TRANSCRIPTS,
        ),
        "analysis_population": lambda s, d: plans.population_properties(
            s, _release_store(s, d), spread_scan=True
        ),
    }


# ---------------------------------------------------------------------------- oracle SQL

# This engine's patterns take no stack, so they need no possessive quantifiers.
_WORD = r"[\p{L}\p{N}\p{M}]+(?:[''’][\p{L}\p{N}\p{M}]+)*"
_WORDS = f"regexp_extract_all(text, '{_WORD}')"


def _plain(word: str) -> str:
    return f"lower(replace({word}, '’', ''''))"



_UTTERANCES = """utterances AS (
    SELECT conv_id AS transcript_id, turn AS utterance_order, role AS speaker, text
    FROM conversations)"""

_LINES = """lines AS (
    SELECT doc_id AS transcript_id, source AS corpus, lang AS speaker,
           unnest(string_split(text, chr(10))) AS text,
           generate_subscripts(string_split(text, chr(10)), 1) AS utterance_order
    FROM documents)"""


_COMPARED = """WITH old AS (
                SELECT source, doc_id, 'main' AS collection, text
                FROM documents WHERE lang <> 'fr'),
            new AS (
                SELECT source, doc_id, translate(text, chr(10), ' ') AS text,
                       CASE WHEN source = 'src5' THEN 'phonological' ELSE 'main' END
                           AS collection
                FROM documents WHERE source <> 'src3')
            SELECT coalesce(old.source, new.source) AS corpus,
                   coalesce(old.doc_id, new.doc_id) AS transcript_id,
                   (CASE WHEN old.doc_id IS NULL THEN 0 ELSE 1 END)::bigint AS n_old,
                   (CASE WHEN new.doc_id IS NULL THEN 0 ELSE 1 END)::bigint AS n_new,
                   CASE WHEN old.doc_id IS NULL THEN 'added'
                        WHEN new.doc_id IS NULL THEN 'removed'
                        WHEN old.collection IS DISTINCT FROM new.collection THEN 'moved'
                        WHEN old.text IS DISTINCT FROM new.text THEN 'revised'
                        ELSE 'same' END AS status
            FROM old FULL OUTER JOIN new
              ON old.source = new.source AND old.doc_id = new.doc_id"""

_BY_LENGTH = f"""{_LINES}, binned AS (
            SELECT lines.*, floor(n_chars / 1000)::bigint AS bin
            FROM lines JOIN documents ON transcript_id = doc_id)"""


_NEWER = f"""{_LINES}, newer AS (SELECT * FROM lines WHERE transcript_id % 3 <> 0)"""

# Ids are places in the order of corpus and name.
_COLLECTION = f"""{_UTTERANCES}, named AS (
            SELECT DISTINCT transcript_id AS conv_id, 'c' || transcript_id % 4 AS corpus,
                   'conv-' || transcript_id AS transcript_key
            FROM utterances),
        ids AS (
            SELECT *, row_number() OVER (ORDER BY corpus, transcript_key) AS transcript_id,
                   CASE WHEN corpus = 'c3' THEN 'phon' ELSE 'main' END AS collection
            FROM named),
        spoken AS (
            SELECT ids.transcript_id, corpus, speaker, 'a ' || speaker AS role, text,
                   row_number() OVER (PARTITION BY conv_id ORDER BY utterance_order)
                       AS utterance_order,
                   lower(text) AS phonology
            FROM ids JOIN utterances u ON ids.conv_id = u.transcript_id)"""

# A set of lines is named by its sorted members; 0 is the old side and 1 the new one.
_MATCHED = f"""WITH {_LINES},
        sets AS (
            SELECT DISTINCT 0 AS side, transcript_id AS id, speaker, text FROM lines
            UNION ALL
            SELECT DISTINCT 1,
                   CASE WHEN transcript_id % 2 = 0 THEN transcript_id + 1000000
                        ELSE transcript_id END,
                   speaker,
                   CASE WHEN utterance_order = 1 AND transcript_id % 5 = 1
                        THEN text || ' (revised)' ELSE text END
            FROM lines WHERE transcript_id % 7 <> 3),
        profiles AS (
            SELECT side, id, count(*) AS n,
                   md5(string_agg(speaker || chr(1) || text, chr(2) ORDER BY speaker, text)) AS content
            FROM sets GROUP BY side, id),
        same AS (
            SELECT o.id AS old_id, w.id AS new_id, o.n
            FROM profiles o JOIN profiles w USING (id, content) WHERE o.side = 0 AND w.side = 1),
        left1 AS (
            SELECT *, row_number() OVER (PARTITION BY side, content ORDER BY id) AS k
            FROM profiles WHERE id NOT IN (SELECT old_id FROM same)),
        renumbered AS (
            SELECT o.id AS old_id, w.id AS new_id, o.n
            FROM left1 o JOIN left1 w USING (content, k) WHERE o.side = 0 AND w.side = 1),
        left2 AS (
            SELECT side, id, n, content,
                   row_number() OVER (PARTITION BY side, content ORDER BY id) AS k,
                   min(id) OVER (PARTITION BY side, content) AS class
            FROM left1
            WHERE NOT (side = 0 AND id IN (SELECT old_id FROM renumbered))
              AND NOT (side = 1 AND id IN (SELECT new_id FROM renumbered))),
        held AS (
            SELECT DISTINCT c.side, c.class, c.n, s.speaker, s.text
            FROM left2 c JOIN sets s ON s.side = c.side AND s.id = c.class),
        distinctive AS (
            SELECT speaker, text FROM held GROUP BY speaker, text
            HAVING count(*) FILTER (side = 0) BETWEEN 1 AND 8
               AND count(*) FILTER (side = 1) BETWEEN 1 AND 8),
        pairs AS (
            SELECT DISTINCT o.class AS a, w.class AS b, o.n AS n_old, w.n AS n_new
            FROM held o JOIN distinctive USING (speaker, text) JOIN held w USING (speaker, text)
            WHERE o.side = 0 AND w.side = 1),
        scored AS (
            SELECT a, b, n_old, n_new, count(*) AS n_common,
                   count(*) / (n_old + n_new - count(*)) AS similarity
            FROM pairs JOIN held o ON o.side = 0 AND o.class = a
                 JOIN held w ON w.side = 1 AND w.class = b
                      AND w.speaker = o.speaker AND w.text = o.text
            GROUP BY a, b, n_old, n_new),
        ranked AS (
            SELECT *, row_number() OVER (PARTITION BY a ORDER BY similarity DESC, a <> b, b) AS of_a,
                   row_number() OVER (PARTITION BY b ORDER BY similarity DESC, a <> b, a) AS of_b
            FROM scored WHERE similarity >= 0.5),
        revised AS (
            SELECT o.id AS old_id, w.id AS new_id, n_old, n_new, n_common, similarity
            FROM ranked JOIN left2 o ON o.side = 0 AND o.class = a
                 JOIN left2 w ON w.side = 1 AND w.class = b AND w.k = o.k
            WHERE of_a = 1 AND of_b = 1)
        SELECT old_id, new_id, 'same' AS status, n AS n_old, n AS n_new, n AS n_common,
               1.0::double AS similarity FROM same
        UNION ALL SELECT old_id, new_id, 'renumbered', n, n, n, 1.0 FROM renumbered
        UNION ALL SELECT old_id, new_id, 'revised', n_old, n_new, n_common, similarity FROM revised
        UNION ALL SELECT id, NULL, 'removed', n, NULL, NULL, NULL FROM left2
        WHERE side = 0 AND id NOT IN (SELECT old_id FROM revised)
        UNION ALL SELECT NULL, id, 'added', NULL, n, NULL, NULL FROM left2
        WHERE side = 1 AND id NOT IN (SELECT new_id FROM revised)"""

# What was done to each line says what the alignment must find: lines are told apart by their
# number, and no two edits are in one gap.
_ALIGNED = f"""WITH {_LINES}, counted AS (
            SELECT transcript_id AS t, utterance_order AS k, transcript_id % 4 <> 0 AS edited,
                   max(utterance_order) OVER (PARTITION BY transcript_id) AS n
            FROM lines)
        SELECT t AS transcript_id, k AS old_order,
               CASE WHEN NOT edited THEN k WHEN k % 10 = 3 THEN NULL
                    WHEN k = 2 AND n >= 8 THEN 2 * n + 2 ELSE 2 * k END AS new_order,
               CASE WHEN NOT edited THEN 'same' WHEN k % 10 = 3 THEN 'deleted'
                    WHEN k % 10 = 7 THEN 'changed' WHEN k = 2 AND n >= 8 THEN 'moved'
                    ELSE 'same' END AS status
        FROM counted
        UNION ALL
        SELECT t, NULL, 2 * k + 1, 'inserted' FROM counted WHERE edited AND k % 10 = 0"""


def _sql_moving_ttr(by: str, window: int) -> str:
    """Every run counted by itself."""
    return f"""WITH {_LINES}, cut AS (
            SELECT {by}, transcript_id, utterance_order, generate_subscripts({_WORDS}, 1) AS k,
                   {_plain(f'unnest({_WORDS})')} AS word
            FROM lines),
        runs AS (
            SELECT {by}, count(DISTINCT word) OVER (
                       PARTITION BY {by} ORDER BY transcript_id, utterance_order, k
                       ROWS BETWEEN {window - 1} PRECEDING AND CURRENT ROW) AS types,
                   row_number() OVER (
                       PARTITION BY {by} ORDER BY transcript_id, utterance_order, k) AS place
            FROM cut)
        SELECT {by}, count(*) AS n_tokens, greatest(count(*) - {window - 1}, 0)::bigint AS n_windows,
               (sum(types) FILTER (place >= {window}))::bigint
                   / nullif({window} * (count(*) - {window - 1}), 0) AS mttr
        FROM runs GROUP BY {by}"""


def _sql_frequency(view: str, source: str, by: str) -> str:
    return f"""WITH {view}, cut AS (
            SELECT {by}, {_plain(f'unnest({_WORDS})')} AS word FROM {source})
        SELECT {by}, word, count(*) AS n FROM cut GROUP BY {by}, word"""


def _sql_mlu(view: str, source: str, by: str, extra: str = "", where: str = "true") -> str:
    return f"""WITH {view}, counted AS (
            SELECT *, coalesce(len({_WORDS}), 0) AS k FROM {source} WHERE {where})
        SELECT {by}{extra}, count(*) FILTER (k > 0) AS n_utterances,
               sum(k)::bigint AS n_tokens,
               sum(k)::bigint / nullif(count(*) FILTER (k > 0), 0) AS mlu_w
        FROM counted GROUP BY {by}"""


def _sql_ttr(view: str, source: str, by: str) -> str:
    return f"""WITH {view}, cut AS (
            SELECT {by}, {_plain('w.word')} AS word
            FROM {source} LEFT JOIN LATERAL (SELECT unnest({_WORDS}) AS word) w ON true)
        SELECT {by}, count(DISTINCT word) AS n_types, count(word) AS n_tokens,
               count(DISTINCT word) / nullif(count(word), 0) AS ttr
        FROM cut GROUP BY {by}"""


def _binned(view: str, source: str, width: int) -> str:
    return f"""{view}, binned AS (
            SELECT *, floor(utterance_order / {width})::bigint AS bin FROM {source})"""


def _own_oracle_sql() -> dict[str, str]:
    current = f"""WITH {_LINES}
        SELECT transcript_id, utterance_order, corpus, speaker, text,
               lower(text) AS phonology, '2020.1' AS release FROM lines"""
    return {
        "word_frequency": _sql_frequency(_UTTERANCES, "utterances", "speaker"),
        "mlu_w": _sql_mlu(_UTTERANCES, "utterances", "speaker"),
        "type_token_ratio": _sql_ttr(_UTTERANCES, "utterances", "speaker"),
        "growth_curve_mlu": _sql_mlu(
            _binned(_UTTERANCES, "utterances", 1), "binned", "speaker, bin"
        ),
        "growth_curve_ttr": _sql_ttr(
            _binned(_UTTERANCES, "utterances", 2), "binned", "speaker, bin"
        ),
        "word_frequency_by_corpus": _sql_frequency(_LINES, "lines", "corpus, speaker"),
        "mlu_w_by_corpus": _sql_mlu(_LINES, "lines", "corpus, speaker"),
        "type_token_ratio_by_corpus": _sql_ttr(_LINES, "lines", "corpus, speaker"),
        "population_utterances": f"""WITH {_LINES}
            SELECT corpus, speaker, count(*) AS n_utterances FROM lines
            GROUP BY corpus, speaker""",
        "population_tokens": f"""WITH {_LINES}
            SELECT corpus, speaker, sum(coalesce(len({_WORDS}), 0))::bigint AS n_tokens
            FROM lines GROUP BY corpus, speaker""",
        "population": f"""WITH {_LINES}
            SELECT corpus, speaker, count(*) AS n_utterances,
                   sum(coalesce(len({_WORDS}), 0))::bigint AS n_tokens
            FROM lines GROUP BY corpus, speaker""",
        "growth_curve_mlu_lines": _sql_mlu(
            _binned(_LINES, "lines", 10), "binned", "speaker, bin"
        ),
        "growth_curve_ttr_lines": _sql_ttr(
            _binned(_LINES, "lines", 10), "binned", "speaker, bin"
        ),
        "tokenize": f"""WITH {_UTTERANCES}
            SELECT transcript_id, utterance_order, speaker, text,
                   array_to_string(list_transform({_WORDS}, lambda w: {_plain('w')}), ' ') AS words,
                   coalesce(len({_WORDS}), 0)::bigint AS n_tokens
            FROM utterances""",
        "tokens": f"""WITH {_UTTERANCES}
            SELECT transcript_id, utterance_order, speaker,
                   generate_subscripts({_WORDS}, 1) AS token_order,
                   {_plain(f'unnest({_WORDS})')} AS word
            FROM utterances""",
        "lines_as_utterances": f"WITH {_LINES} SELECT * FROM lines",
        "with_corpus": f"WITH {_LINES} SELECT * FROM lines",
        "with_corpus_salted": f"WITH {_LINES} SELECT * FROM lines",
        "for_speakers": f"""WITH {_UTTERANCES}
            SELECT * FROM utterances WHERE speaker IN ('user', 'system')""",
        "for_corpora": f"""WITH {_LINES}
            SELECT * FROM lines WHERE corpus IN ('src1', 'src12')""",
        "read_release": current,
        "read_release_named": f"""WITH {_LINES}
            SELECT transcript_id, utterance_order, corpus, speaker, text,
                   NULL::varchar AS phonology, '2019.1' AS release
            FROM lines WHERE speaker <> 'fr'""",
        "stamp_release": _sql_mlu(_LINES, "lines", "speaker", ", '2020.1' AS release"),
        "union_releases": f"""{current}
            UNION ALL
            SELECT transcript_id, utterance_order, corpus, speaker, text, NULL, '2019.1'
            FROM lines WHERE speaker <> 'fr'
            UNION ALL
            SELECT transcript_id, utterance_order, corpus, speaker, text, NULL, '2018.1'
            FROM lines WHERE speaker = 'en'""",
        "compare_releases": _COMPARED,
        "compare_releases_unique": _COMPARED,
        "read_release_tokens": f"""WITH {_LINES}
            SELECT transcript_id, utterance_order, corpus, speaker,
                   generate_subscripts({_WORDS}, 1) AS token_order,
                   {_plain(f'unnest({_WORDS})')} AS word, '2020.1' AS release
            FROM lines""",
        "read_release_corpora": """
            SELECT DISTINCT source AS corpus, 'main' AS collection, '2020.1' AS release
            FROM documents""",
        "word_frequency_stored_tokens": _sql_frequency(_LINES, "lines", "corpus, speaker"),
        "analysis_frequency_all": f"""WITH {_LINES}, cut AS (
                SELECT speaker, {_plain(f'unnest({_WORDS})')} AS word FROM lines)
            SELECT speaker, word, count(*) AS n, '2020.1' AS release
            FROM cut GROUP BY speaker, word""",
        "analysis_growth_all": f"""SELECT *, '2020.1' AS release FROM (
            {_sql_ttr(_binned(_LINES, "lines", 5), "binned", "speaker, bin")})""",
        "analysis_growth_by_transcript": _sql_mlu(
            _BY_LENGTH, "binned", "speaker, bin", ", '2020.1' AS release"
        ),
        "analysis_growth_ttr_by_transcript": f"""SELECT *, '2020.1' AS release FROM (
            {_sql_ttr(_BY_LENGTH, "binned", "speaker, bin")})""",
        "load_manifest": f"""WITH {_LINES}
            SELECT '2018.1' AS release, false AS is_current, count(*) AS n_utterances
            FROM lines WHERE speaker = 'en'
            UNION ALL
            SELECT '2019.1', false, count(*) FROM lines WHERE speaker <> 'fr'
            UNION ALL
            SELECT '2020.1', true, count(*) FROM lines""",
        "resolve_release": f"""WITH {_LINES}
            SELECT speaker, count(*) AS n_utterances, '2020.1' AS release
            FROM lines GROUP BY speaker
            UNION ALL
            SELECT speaker, count(*), '2018.1' FROM lines WHERE speaker = 'en'
            GROUP BY speaker""",
        "mirror_release": f"""WITH {_LINES}
            SELECT *, lower(text) AS phonology FROM lines""",
        "ingest_transcripts": f"WITH {_UTTERANCES} SELECT * FROM utterances",
        "ingest_transcripts_split": f"WITH {_UTTERANCES} SELECT * FROM utterances",
        "ingest_tokens": f"""WITH {_UTTERANCES}, split AS (
                SELECT *, list_filter(string_split(text, ' '), lambda w: w <> '') AS words
                FROM utterances)
            SELECT transcript_id, utterance_order, speaker,
                   generate_subscripts(words, 1) AS token_order,
                   {_plain('unnest(words)')} AS word
            FROM split""",
        "ingest_corpora": f"""WITH {_COLLECTION}
            SELECT corpus, collection, count(*) AS n_transcripts FROM ids
            GROUP BY corpus, collection""",
        "ingest_transcript_table": f"""WITH {_COLLECTION}
            SELECT transcript_id, transcript_key, corpus, collection FROM ids""",
        "ingest_participants": f"""WITH {_COLLECTION}
            SELECT DISTINCT transcript_id, corpus, speaker, role FROM spoken""",
        "ingest_collection_utterances": f"""WITH {_COLLECTION} SELECT * FROM spoken""",
        "ingest_collection_tokens": f"""WITH {_COLLECTION}
            SELECT transcript_id, utterance_order, corpus, speaker,
                   generate_subscripts({_WORDS}, 1) AS token_order,
                   {_plain(f'unnest({_WORDS})')} AS word
            FROM spoken""",
        "match_transcripts": _MATCHED,
        "compare_utterances": _ALIGNED,
        "word_frequency_delta": _sql_frequency(_NEWER, "newer", "corpus, speaker"),
        "mlu_w_delta": _sql_mlu(_NEWER, "newer", "corpus, speaker"),
        "type_token_ratio_delta": _sql_ttr(_NEWER, "newer", "corpus, speaker"),
        "population_delta": f"""WITH {_NEWER}
            SELECT corpus, speaker, count(*) AS n_utterances,
                   sum(coalesce(len({_WORDS}), 0))::bigint AS n_tokens
            FROM newer GROUP BY corpus, speaker""",
        "corpus_conflicts": f"""WITH {_LINES}, numbered AS (
                SELECT *, regexp_extract(corpus, '(\\d+)', 1)::bigint AS i FROM lines)
            SELECT transcript_id, 'src' || (i + 1) AS stored, corpus, count(*) AS n_rows
            FROM numbered WHERE i % 3 = 0 AND utterance_order % 2 = 0
            GROUP BY transcript_id, i, corpus""",
        "with_corpus_bucketed": f"WITH {_LINES} SELECT * FROM lines",
        "compare_releases_bucketed": f"SELECT * EXCLUDE (corpus) FROM ({_COMPARED})",
        "mirror_ranges": current,
        "differing_ranges": """
            SELECT 0::bigint AS low, 100::bigint AS high,
                   count(*) FILTER (doc_id < 100) AS n_first,
                   count(*) FILTER (doc_id < 100) AS n_second
            FROM documents
            UNION ALL
            SELECT 200, 300, count(*), count(*) FROM documents WHERE doc_id BETWEEN 200 AND 299""",
        "union_releases_widened": """
            SELECT doc_id::varchar AS doc_id, lang, n_chars::varchar AS n_chars
            FROM documents WHERE lang = 'en'
            UNION ALL
            SELECT doc_id::varchar, lang, n_chars::varchar FROM documents WHERE lang <> 'fr'
            UNION ALL
            SELECT doc_id::varchar, lang, n_chars || ' characters' FROM documents""",
        "sql_word_frequency": f"""SELECT *, '2019.1' AS release FROM (
            {_sql_frequency(_LINES, "lines", "speaker")}) WHERE speaker IN ('de', 'en')""",
        "sql_mlu_w": _sql_mlu(_LINES, "lines", "speaker", ", '2020.1' AS release"),
        "sql_type_token_ratio": f"""SELECT *, '2018.1' AS release FROM (
            {_sql_ttr(_LINES, "lines", "speaker")}) WHERE speaker = 'en'""",
        "sql_population": f"""WITH {_LINES}
            SELECT corpus, speaker, count(*) AS n_utterances,
                   sum(coalesce(len({_WORDS}), 0))::bigint AS n_tokens, '2020.1' AS release
            FROM lines WHERE corpus IN ('src0', 'src7') GROUP BY corpus, speaker
            HAVING sum(coalesce(len({_WORDS}), 0)) > 100""",
        "estimated_type_token_ratio": f"""WITH {_LINES}
            SELECT speaker, sum(coalesce(len({_WORDS}), 0))::bigint AS n_tokens, true AS is_near
            FROM lines GROUP BY speaker""",
        "moving_type_token_ratio": _sql_moving_ttr("speaker", 50),
        "moving_type_token_ratio_by_corpus": _sql_moving_ttr("corpus, speaker", 20),
        "analysis_frequency": f"""WITH {_LINES}, cut AS (
                SELECT speaker, {_plain(f'unnest({_WORDS})')} AS word
                FROM lines WHERE corpus IN ('src0', 'src7'))
            SELECT speaker, word, count(*) AS n, '2020.1' AS release
            FROM cut GROUP BY speaker, word""",
        "analysis_derived_measures": _sql_mlu(
            _binned(_LINES, "lines", 5),
            "binned",
            "speaker, bin",
            ", '2019.1' AS release",
            "speaker IN ('de', 'en')",
        ),
        "analysis_population": f"""WITH {_LINES}
            SELECT corpus, speaker, count(*) AS n_utterances,
                   sum(coalesce(len({_WORDS}), 0))::bigint AS n_tokens, '2020.1' AS release
            FROM lines GROUP BY corpus, speaker""",
    }
