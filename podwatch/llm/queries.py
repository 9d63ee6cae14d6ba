"""The registered queries of the operators. Each derives the columns of its contract from the operator's output."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from podwatch.llm import chat, warc
from podwatch.llm.decontaminate import contaminated
from podwatch.llm.fingerprints import fingerprints
from podwatch.llm.line_dedup import line_dedup
from podwatch.llm.mixing import mix
from podwatch.llm.near_dedup import near_duplicates
from podwatch.llm.packing import packed
from podwatch.llm.periodic_runs import periodic_runs
from podwatch.llm.quality import quality_scores
from podwatch.llm.token_counts import token_counts
from podwatch.llm.url_filters import url_host, url_verdicts
from podwatch.llm.whitening import whitened


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = warc.round_trip(table(spark, sf_dir, "pages"))
    return found.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op2_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = line_dedup(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("kept_sha256"))


def op4_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints(table(spark, sf_dir, "documents"))


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return quality_scores(docs, table(spark, sf_dir, "labels")).select("doc_id", "held_out", "score", "predicted")


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return token_counts(docs, tokenizer_path("word_bpe_49k.json"))


def op7_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    says = "</s>[INST] ok [/INST]"
    own = spark.createDataFrame([(-1, 0, "user", says), (-1, 1, "assistant", says)], "conv_id long, turn long, role string, text string")
    found = chat.read_back(chat.format_conversations(turns.unionByName(own)))
    said = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return found.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(said, 256).alias("turns_sha256"),
        F.length("loss_text").cast("long").alias("loss_chars"),
        F.sha2("loss_text", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


_EPOCH = "2024-01-01 00:00:00"


def _day(days: F.Column) -> F.Column:
    return F.timestamp_seconds(F.unix_timestamp(F.lit(_EPOCH).cast("timestamp")) + days.cast("long") * 86_400)


def derived_captures(pages: DataFrame) -> DataFrame:
    """A fetch time within the year for every page, from its id."""
    minutes = F.col("page_id") * 7_919 % (366 * 1_440)
    start = F.unix_timestamp(F.lit(_EPOCH).cast("timestamp"))
    return pages.select("page_id", "url", F.timestamp_seconds(start + minutes * 60).alias("fetched_at"))


def derived_entries(pages: DataFrame) -> DataFrame:
    """Three dated lists over the hosts, domains and first path parts that the pages have."""
    host = url_host(F.col("url"))
    first = F.regexp_extract("url", r"^[a-z]+://[^/?#]*/([^/?#]+)", 1)
    hosts = pages.select(host.alias("host"), first.alias("first")).where("host <> ''").distinct()

    def number(c: str) -> F.Column:
        return F.conv(F.substring(F.md5(c), 1, 6), 16, 10).cast("long")

    def dated(rows: DataFrame, name: str, which: F.Column, events: list[tuple[int, str]]) -> DataFrame:
        rows = rows.distinct().withColumn("v", number("pattern")).where(which)
        each = F.explode(F.array(*(F.struct((F.col("v") % 200 + d).alias("day"), F.lit(a).alias("action")) for d, a in events)))
        rows = rows.select("pattern", each.alias("e"))
        return rows.select(F.lit(name).alias("list"), "pattern", F.col("e.action").alias("action"), _day(F.col("e.day")).alias("since"))

    of_hosts = hosts.select(F.col("host").alias("pattern"))
    of_domains = hosts.select(F.concat(F.lit("*."), F.substring_index("host", ".", -3)).alias("pattern"))
    of_paths = hosts.where("first <> ''").select(F.concat("host", F.lit("/"), "first").alias("pattern"))
    v = F.col("v")
    found = dated(of_hosts, "hosts", v % 3 == 0, [(0, "block"), (60, "end"), (120, "block")])
    found = found.unionByName(dated(of_domains, "domains", v % 2 == 1, [(-100, "block"), (70, "allow"), (140, "end")]))
    return found.unionByName(dated(of_paths, "paths", v % 5 == 2, [(10, "allow"), (90, "block")]))


def op8_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    found = url_verdicts(derived_captures(pages), derived_entries(pages))
    seconds = [F.unix_timestamp(c).alias(c) for c in ("fetched_at", "since")]
    return found.select("page_id", "host", "verdict", "list", "pattern", *seconds)


def op9_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op10_columns(found: DataFrame) -> DataFrame:
    return found.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset", "tier", "step_group"
    )


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op10_columns(packed(table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json")))


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitened(table(spark, sf_dir, "embeddings"))


def repeated_texts(docs: DataFrame) -> DataFrame:
    """The documents; in those whose crc32(doc_id) ends in 0 the words from some place on repeat with a period."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    words = F.filter(F.split("text", r"[\x20\x09-\x0D]+"), lambda w: w != "")
    chosen = docs.where((h % 10 == 0) & F.col("text").rlike(r"[^\x20\x09-\x0D]"))
    chosen = chosen.select("doc_id", words.alias("w"), F.floor(h / 10).alias("g")).withColumn("n", F.size("w"))
    chosen = chosen.withColumn("a", (F.col("g") % F.col("n")).cast("int"))
    chosen = chosen.withColumn("p", (1 + F.floor((F.col("n") - F.col("a")) / (3 + F.col("g") % 8))).cast("int"))
    a, p = F.col("a"), F.col("p")
    places = F.transform(F.sequence(F.lit(0), F.col("n") - 1), lambda i: F.when(i < a, i).otherwise(a + (i - a) % p))
    text = F.array_join(F.transform(places, lambda i: F.get("w", i)), " ")
    others = docs.where(~F.coalesce((h % 10 == 0) & F.col("text").rlike(r"[^\x20\x09-\x0D]"), F.lit(False)))
    return others.select("doc_id", "text").union(chosen.select("doc_id", text.alias("text")))


def op12_columns(found: DataFrame) -> DataFrame:
    # Greatest length / period, compared exactly; then the smallest start, then the smallest period.
    def before(x: F.Column, y: F.Column) -> F.Column:
        far = x["length"] * y["period"] - y["length"] * x["period"]
        return F.when(far != 0, far > 0).when(x["start"] != y["start"], x["start"] < y["start"]).otherwise(x["period"] < y["period"])

    best = F.aggregate(F.slice("runs", 2, F.greatest(F.size("runs"), F.lit(1))), F.get("runs", F.lit(0)), lambda x, y: F.when(before(y, x), y).otherwise(x))
    line = lambda r: F.concat(r["start"].cast("string"), F.lit(","), r["length"].cast("string"), F.lit(","), r["period"].cast("string"), F.lit("\n"))
    found = found.withColumn("best", best)
    return found.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        *(F.col(f"best.{c}").alias(c) for c in ("start", "length", "period")),
        F.expr("1000 * best.length DIV best.period").alias("exponent_milli"),
        F.sha2(F.array_join(F.transform("runs", line), ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op12_columns(periodic_runs(repeated_texts(table(spark, sf_dir, "documents"))))


def op13_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    taken = F.aggregate("draws", F.lit(0).cast("long"), lambda total, d: total + d["words"])
    found = mix(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "size", "source_size", "target", taken.alias("taken"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_warc,
        op2_near_dedup,
        op3_line_dedup,
        op4_fingerprints,
        op5_quality,
        op6_token_counts,
        op7_chat,
        op8_url_filters,
        op9_decontaminate,
        op10_packing,
        op11_whitening,
        op12_periodic_runs,
        op13_mixing,
    )
}
