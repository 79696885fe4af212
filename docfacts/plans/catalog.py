"""The registered queries: one or more per operator, each over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docfacts.functions import text as text_fns
from docfacts.operators import (
    chunk,
    evaluate,
    extract,
    intake,
    parse,
    quality,
    resolve,
    retrieve,
    synth,
    upsert,
    validate,
)
from docfacts.plans import derived
from docfacts.plans.derived import table
from docfacts.schemas import ATTEMPT, LINK, RECORD_FIELDS, REGISTRY
from docfacts.session import scratch_dir, shuffles_let_go
from docfacts.sources import readers, writers
from docfacts.sources.keyed import KeyedTable
from docfacts.sources.prefixed import PrefixedTable
from docfacts.sources.vector_index import VectorIndex
from docfacts.streaming import online, state

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

# Words counted for the exact retrieval query, and the counts searched for.
COUNTED_WORDS = ("the", "que", "der", "la")
WANTED_COUNTS = [3.0, 3.0, 3.0, 3.0]
# Fixed value: seconds that resolution may take.
RESOLVE_SECONDS = 120
# Batches of the stream queries.
MICRO_BATCHES = 4


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


# --- stages the queries share ------------------------------------------------------


def _uploads(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select(
        "doc_id", F.col("doc_id").cast("string").alias("report_id"), "text", "source"
    )


def _records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Facts read from the derived reports: the input of validation."""
    reports = derived.reports(table(spark, sf_dir, "orders"))
    return parse.stated_facts(reports).drop("text")


def _valid_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return validate.split(validate.check(_records(spark, sf_dir)))[0]


def _occurrences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resolve.occurrences(_valid_records(spark, sf_dir))


def _outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gate outcomes on the derived model outputs, replayed attempt by attempt."""
    replay = extract.ColumnProvider(lambda prompt, attempt: F.col(f"output_{attempt}"))
    return extract.run(derived.outputs(table(spark, sf_dir, "orders")), replay)


# --- intake ------------------------------------------------------------------------


@query
def intake_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    gated = intake.gate(_uploads(spark, sf_dir), "doc_id")
    return intake.with_response(gated).select(
        "report_id", "content_hash", "status", "error", "status_code"
    )


@query
def intake_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return intake.summary(intake.gate(_uploads(spark, sf_dir), "doc_id"))


@query
def intake_registry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One source was taken in by an earlier run; now all documents arrive."""
    uploads = _uploads(spark, sf_dir)
    earlier = intake.gate(uploads.filter(F.col("source") == "src0"), "doc_id")
    gated = intake.gate(uploads, "doc_id", registry=intake.new_hashes(earlier))
    return gated.select("report_id", "content_hash", "status")


@query
def intake_resent(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document arrives twice under its id, ordered by that id alone."""
    uploads = _uploads(spark, sf_dir)
    gated = intake.gate(uploads.unionByName(uploads), "report_id")
    return gated.groupBy("report_id", "content_hash", "status").agg(F.count("*").alias("n_uploads"))


@query
def accepted_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return intake.accepted_documents(intake.gate(_uploads(spark, sf_dir), "doc_id"))


def _arriving(rows: DataFrame, by: F.Column) -> DataFrame:
    """``rows`` as a stream of ``MICRO_BATCHES`` batches in the order of ``by``, a whole number.

    The parts are written one after another, each by all tasks, and every trigger takes as many
    files as a part has. Rows without ``by`` come in the first.
    """
    spark = rows.sparkSession
    path, files = scratch_dir(spark, "arriving"), spark.sparkContext.defaultParallelism
    low, high = rows.agg(F.min(by), F.max(by)).first()
    width = ((high or 0) - (low or 0)) // MICRO_BATCHES + 1
    number_of = F.coalesce(F.floor((by - F.lit(low or 0)) / width), F.lit(0))
    for number in range(MICRO_BATCHES):
        rows.filter(number_of == number).repartition(files).write.mode("append").parquet(path)
    return spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", files).parquet(path)


def _document_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    arriving = _arriving(table(spark, sf_dir, "documents"), F.col("doc_id"))
    return arriving.withColumn("report_id", F.col("doc_id").cast("string"))


@query
def intake_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    work = scratch_dir(spark, "intake-stream")
    accepted = online.intake_stream(_document_stream(spark, sf_dir)).select("content_hash", "report_id")
    online.land(accepted, f"{work}/accepted", f"{work}/state").awaitTermination()
    return readers.parquet_or_empty(spark, f"{work}/accepted", REGISTRY).select("content_hash")


def _stream_verdicts(spark: SparkSession, sf_dir: str, registry: DataFrame | None = None) -> DataFrame:
    work = scratch_dir(spark, "intake-verdicts")
    stream = _document_stream(spark, sf_dir).select("doc_id", "report_id", "text")
    online.land(state.verdicts(stream, "doc_id", registry), f"{work}/verdicts", f"{work}/state").awaitTermination()
    return spark.read.parquet(f"{work}/verdicts").select("report_id", "content_hash", "status")


@query
def intake_stream_verdicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _stream_verdicts(spark, sf_dir)


@query
def intake_stream_registry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One source was taken in by an earlier run; now all documents arrive as a stream."""
    earlier = intake.gate(_uploads(spark, sf_dir).filter(F.col("source") == "src0"), "doc_id")
    return _stream_verdicts(spark, sf_dir, intake.new_hashes(earlier))


# --- passages and retrieval --------------------------------------------------------


@query
def chunk_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chunk.chunk(table(spark, sf_dir, "documents"), "doc_id")


@query
def chunk_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    chunks = chunk.chunk(table(spark, sf_dir, "documents"), "doc_id")
    return chunks.groupBy("report_id").agg(
        F.count("*").alias("n_chunks"),
        F.max(F.length("text")).alias("longest"),
        F.sum(F.length("text")).alias("n_chars"),
    )


def _query_vector(vectors: DataFrame) -> list[float]:
    """The vector searched for: the one of vec_id 0, a single row."""
    return [float(x) for x in vectors.filter("vec_id = 0").first()["embedding"]]


def _hits(hits: DataFrame, *columns: str) -> DataFrame:
    return hits.select(*columns, F.round("distance", 6).alias("distance"))


@query
def vector_topk_global(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    hits = retrieve.top_k(vectors, _query_vector(vectors), tie_break="vec_id")
    return _hits(hits, "vec_id", "label")


@query
def vector_topk_where(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Candidates restricted before ranking."""
    vectors = table(spark, sf_dir, "embeddings")
    hits = retrieve.top_k(vectors, _query_vector(vectors), where={"label": 3}, tie_break="vec_id")
    return _hits(hits, "vec_id", "label")


@query
def vector_topk_scoped(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    hits = retrieve.top_k(
        vectors, _query_vector(vectors), retrieve.RETRIEVAL_TOP_K, scope="label", tie_break="vec_id"
    )
    return _hits(hits, "vec_id", "label", "rank")


@query
def vector_cosine_scoped(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    hits = retrieve.top_k(
        vectors,
        _query_vector(vectors),
        retrieve.RETRIEVAL_TOP_K,
        scope="label",
        metric="cosine",
        tie_break="vec_id",
    )
    return _hits(hits, "vec_id", "label", "rank")


@query
def vector_topk_deep(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Thousands of vectors of each label, in order: more than Spark's own limit on ranks."""
    vectors = table(spark, sf_dir, "embeddings")
    hits = retrieve.top_k(vectors, _query_vector(vectors), 5000, scope="label", tie_break="vec_id")
    return _hits(hits, "vec_id", "label", "rank")


@query
def vector_index_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All lists of the index probed: every vector is in it, and the nearest are the exact ones."""
    vectors = table(spark, sf_dir, "embeddings")
    index = VectorIndex(spark, scratch_dir(spark, "vector-index")).build(vectors, lists=16, key="vec_id")
    return _hits(index.search(_query_vector(vectors), 100, probes=16, tie_break="vec_id"), "vec_id", "label")


@query
def vector_index_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Vectors in the index by label, from its lists."""
    path = scratch_dir(spark, "vector-index")
    VectorIndex(spark, path).build(table(spark, sf_dir, "embeddings"), lists=16, key="vec_id")
    return spark.read.parquet(f"{path}/lists").groupBy("label").agg(F.count("*").alias("n_vectors"))


def _count_vectors(chunks: DataFrame) -> DataFrame:
    """Passages with whole-number vectors, so that distances are exact in any engine."""
    counts = [
        F.regexp_count(F.lower("text"), F.lit(word)).cast("double") for word in COUNTED_WORDS
    ]
    return chunks.withColumn("embedding", F.array(*counts))


@query
def retrieval_context(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents of one language are not indexed and fall back to their full text."""
    documents = table(spark, sf_dir, "documents").withColumn(
        "report_id", F.col("doc_id").cast("string")
    )
    index = _count_vectors(chunk.chunk(documents.filter(F.col("lang") != "fr")))
    hits = retrieve.top_k(
        index, WANTED_COUNTS, retrieve.RETRIEVAL_TOP_K, scope="report_id", tie_break="chunk_index"
    )
    found = retrieve.context(documents.select("report_id", "text"), hits)
    return found.select("report_id", "context")


@query
def batch_encoder_hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same vectors from a Python encoder, the nearest passages of each document."""
    words = COUNTED_WORDS

    def load():
        return lambda texts: [[t.lower().count(w) for w in words] for t in texts]

    chunks = chunk.chunk(table(spark, sf_dir, "documents"), "doc_id")
    vectors = retrieve.embed(chunks, retrieve.BatchEncoder(load))
    hits = retrieve.top_k(
        vectors, WANTED_COUNTS, retrieve.RETRIEVAL_TOP_K, scope="report_id", tie_break="chunk_index"
    )
    return hits.select("id", "rank", "distance")


@query
def vector_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Vectors are written, then those of one label are written again under another."""
    vectors = table(spark, sf_dir, "embeddings")
    path = scratch_dir(spark, "vectors")
    stored = KeyedTable(spark, path, vectors.schema, "vec_id")
    stored.put(vectors, 0)
    stored.put(vectors.filter("label = 3").withColumn("label", F.lit(-1)), 1)
    return stored.read().select("vec_id", "label", F.size("embedding").alias("dims"))


@query
def embed_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every component that is not zero of the vector of every passage."""
    chunks = chunk.chunk(table(spark, sf_dir, "documents"), "doc_id")
    vectors = retrieve.embed(chunks)
    return vectors.select("id", F.posexplode("embedding").alias("dim", "value")).filter("value <> 0")


def _retrieved(reports: DataFrame) -> DataFrame:
    """Embed, search and reassemble with the default encoder, fitted on the passages."""
    encoder = retrieve.TermEncoder().fit(chunk.chunk(reports))
    wanted = retrieve.encode_query(reports, encoder)
    return retrieve.retrieve(reports, encoder, wanted).select("report_id", "context")


@query
def retrieve_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The best passages of the derived reports."""
    return _retrieved(derived.reports(derived.spread(table(spark, sf_dir, "orders"))))


@query
def retrieve_document_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The best four of up to thousands of passages of each document."""
    return _retrieved(_uploads(spark, sf_dir).select("report_id", "text"))


# --- extraction --------------------------------------------------------------------


@query
def extract_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _records(spark, sf_dir).select("report_id", *RECORD_FIELDS)


@query
def validate_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    checked = validate.check(_records(spark, sf_dir))
    flags = [
        (~F.array_contains(F.col("errors")["field"], f)).alias(f"{f}_ok")
        for f in ("mineral", "depth_m", "lat", "lon")
    ]
    return checked.select("report_id", "valid", F.size("errors").alias("n_errors"), *flags)


@query
def quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    rejected = validate.split(validate.check(_records(spark, sf_dir)))[1]
    return rejected.select("report_id", "reason")


@query
def parse_model_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    outputs = derived.outputs(table(spark, sf_dir, "orders"))
    parsed = parse.parse_outputs(outputs, "output_1")
    return parsed.select(
        "report_id",
        F.col("record").isNotNull().alias("parsed"),
        *[F.col("record")[f].alias(f) for f in RECORD_FIELDS],
        validate.reason(F.col("type_errors")).alias("problems"),
    )


@query
def prompt_build(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Prompts of a first attempt and of a retry with the validation errors as hint."""
    reports = derived.reports(table(spark, sf_dir, "orders"))
    checked = validate.check(parse.stated_facts(reports))
    hint = F.when(
        ~F.col("valid"), text_fns.retry_hint(validate.reason(F.col("errors")))
    ).otherwise(F.lit(""))
    return checked.select(
        "report_id",
        F.sha2(text_fns.prompt(F.col("text"), F.lit("")), 256).alias("first_prompt"),
        F.sha2(text_fns.prompt(F.col("text"), hint), 256).alias("retry_prompt"),
    )


@query
def extract_step(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One attempt of the rule-based provider: prompt, answer, JSON, typed record."""
    reports = derived.reports(table(spark, sf_dir, "orders")).select(
        "report_id", F.col("text").alias("context"), F.lit("").alias("hint")
    )
    done = extract.extract(reports, extract.provider("rules"))
    return done.select("report_id", *[F.col("record")[f].alias(f) for f in RECORD_FIELDS])


@query
def retry_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _outcomes(spark, sf_dir).select(
        "report_id",
        "status",
        "attempts",
        "reason",
        *[F.col("record")[f].alias(f) for f in RECORD_FIELDS],
    )


@query
def batch_provider_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The gate with a Python provider that reads the prompts it is sent."""

    def connect():
        import json
        import re

        stated = re.compile(
            r"Drill hole (?P<hole_id>\S+) intersected (?P<grade_g_t>[\d.]+) g/t (?P<mineral>\w+) "
            r"at a depth of (?P<depth_m>\d+)m\. Coordinates recorded at the collar: "
            r"(?P<lat>[-\d.]+), (?P<lon>-\d+\.\d+)"
        )

        def ask(prompts, max_tokens):
            return [json.dumps(stated.search(p).groupdict()) for p in prompts]

        return ask

    reports = derived.reports(table(spark, sf_dir, "orders"))
    outcomes = extract.run(reports, extract.BatchProvider(connect))
    return outcomes.select("report_id", "status", "attempts", "reason", "record.mineral")


@query
def ledger_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A provider that reads its hint, behind a ledger; the second run is answered by the ledger.

    It takes holes of odd number for unreadable until a note says that this failed.
    """

    def connect():
        import json
        import re

        hole = re.compile(r"Drill hole (DH-\d+) intersected ([\d.]+) g/t (\w+)")
        depth = re.compile(r"at a depth of (\d+)m")
        place = re.compile(r"at the collar: ([-\d.]+), (-\d+\.\d+)")

        def ask(prompts, max_tokens):
            for prompt in prompts:
                name, grade, mineral = hole.search(prompt).groups()
                lat, lon = place.search(prompt).groups()
                unreadable = int(name[3:]) % 2 and "\nNote: " not in prompt
                yield json.dumps({
                    "mineral": mineral, "depth_m": "illegible" if unreadable else depth.search(prompt)[1],
                    "lat": lat, "lon": lon, "grade_g_t": grade, "hole_id": name,
                })

        return ask

    def never():
        def ask(prompts, max_tokens):
            raise RuntimeError("the ledger has every answer")

        return ask

    reports = derived.reports(derived.spread(table(spark, sf_dir, "orders")))
    path = scratch_dir(spark, "ledger")
    extract.run(reports, extract.LedgerProvider(extract.BatchProvider(connect), path))
    again = extract.run(reports, extract.LedgerProvider(extract.BatchProvider(never), path))
    return again.select("report_id", "status", "attempts", "reason", "record.depth_m")


@query
def attempts_per_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract.attempts_per_report(extract.attempt_log(_outcomes(spark, sf_dir)))


@query
def attempt_admission(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").select("event_id", "ts", "user_id")
    admitted = extract.admit(
        events, ["ts", "event_id"], F.date_trunc("hour", "ts"), key="user_id"
    )
    return admitted.select("event_id", "user_id", "attempts", "allowed")


def _event_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    arriving = _arriving(events, F.unix_micros(F.col("ts").cast("timestamp")))
    return arriving.select("event_id", "ts", F.col("user_id").cast("string").alias("report_id"))


@query
def attempt_counter_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    work = scratch_dir(spark, "attempt-counter")
    counters = KeyedTable(spark, f"{work}/counters", ATTEMPT, "report_id")
    online.each_batch(
        online.attempts(_event_stream(spark, sf_dir)),
        online.put_batch(counters),
        f"{work}/state",
        mode="update",
    ).awaitTermination()
    return counters.read()


@query
def attempt_admission_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    work = scratch_dir(spark, "attempt-admission")
    admitted = state.admissions(_event_stream(spark, sf_dir), ["ts", "event_id"])
    online.land(admitted, f"{work}/verdicts", f"{work}/state").awaitTermination()
    verdicts = spark.read.parquet(f"{work}/verdicts")
    return verdicts.select("event_id", "report_id", "attempts", "allowed")


# --- stored records, resolution, serving -------------------------------------------


def _by_customer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Extractions written again and again under the customer's id."""
    records = derived.records(table(spark, sf_dir, "orders"))
    return records.withColumn("report_id", F.concat(F.lit("CUST-"), F.col("c").cast("string")))


@query
def extraction_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    written = _by_customer(spark, sf_dir)
    kept = upsert.upsert(None, written, "report_id", "k")
    return kept.select("report_id", *RECORD_FIELDS)


@query
def extraction_upsert_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    work = scratch_dir(spark, "extraction-upsert")
    stream = _arriving(table(spark, sf_dir, "orders"), F.col("o_orderkey"))
    written = derived.records(stream).withColumn(
        "report_id", F.concat(F.lit("CUST-"), F.col("c").cast("string"))
    )
    stored = PrefixedTable(
        spark, f"{work}/extractions", _by_customer(spark, sf_dir).schema, "report_id", ["k"], digits=1, fan_in=3
    )
    online.each_batch(written, online.put_batch(stored), f"{work}/state").awaitTermination()
    return stored.read().select("report_id", *RECORD_FIELDS)


@query
def resolve_occurrences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _occurrences(spark, sf_dir).select(
        *resolve.SITE,
        "n_reports",
        F.round("avg_depth_m", 6).alias("avg_depth_m"),
        F.round("avg_grade_g_t", 6).alias("avg_grade_g_t"),
    )


@query
def validate_missing_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records with absent fields by key class: every field is required, errors follow the fields."""
    known = derived.records(table(spark, sf_dir, "orders"))
    spoilt = {"depth_m": 9, "grade_g_t": 5, "hole_id": 6, "mineral": 11}
    absent = {f: F.when(F.col("k") % n != 0, F.col(f)) for f, n in spoilt.items()}
    checked = validate.check(known.withColumns(absent))
    return checked.select("report_id", "valid", validate.reason(F.col("errors")).alias("reason"))


@query
def resolve_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every report of every site."""
    return resolve.links(_valid_records(spark, sf_dir))


@query
def resolve_report_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same from the written table that is served beside the occurrences."""
    path = scratch_dir(spark, "links")
    writers.write_occurrences(_valid_records(spark, sf_dir), path)
    return readers.parquet_or_empty(spark, f"{path}/links", LINK)


@query
def resolve_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resolve.stats(_occurrences(spark, sf_dir))


@query
def occurrences_by_region(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resolve.by_region(_occurrences(spark, sf_dir))


@query
def resolve_merged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each order priority is resolved by a run of its own, then their totals are merged."""
    orders = table(spark, sf_dir, "orders")
    names = [row[0] for row in orders.select("o_orderpriority").distinct().collect()]
    path = scratch_dir(spark, "totals")
    for number, name in enumerate(names):
        run = orders.filter(F.col("o_orderpriority").eqNullSafe(F.lit(name)))
        valid = validate.split(validate.check(derived.records(run)))[0]
        resolve.totals(resolve.with_site(valid)).write.parquet(f"{path}/run={number}")
    known = resolve.merged(spark.read.parquet(path).drop("run"))
    return resolve.by_region(resolve.facts_of(known))


@query
def search_occurrences(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = resolve.search(_occurrences(spark, sf_dir), "Gold")
    return found.select(*resolve.SITE, "n_reports")


@query
def search_all_occurrences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """No mineral given: everything, in the same order."""
    found = resolve.search(_occurrences(spark, sf_dir), "")
    return found.select(*resolve.SITE, "n_reports")


@query
def lookup_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resolve.lookup(_valid_records(spark, sf_dir), "RPT-5")


# --- sources and sinks -------------------------------------------------------------


@query
def typed_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records stored with every value as text under its type, then scanned."""
    path = scratch_dir(spark, "stored")
    writers.write_stored(derived.records(table(spark, sf_dir, "orders")), path)
    return readers.read_stored(spark, path)


@query
def document_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents accepted twice under one id: the later text replaces the earlier.

    First everything arrives, then all documents with a language again with a note, which makes
    them new texts; what intake accepts is put into the table of documents both times. The verdicts
    are kept without the texts, which are shuffled once, by the put.
    """
    base = scratch_dir(spark, "document-versions")
    uploads = table(spark, sf_dir, "documents").select("doc_id", F.col("doc_id").cast("string").alias("report_id"), "text", "lang")
    note = F.concat("text", F.lit(" Corrected in "), "lang")
    waves = [uploads, uploads.filter(F.col("lang").isNotNull()).withColumn("text", note)]
    stored = None
    for number, wave in enumerate(waves):
        known = readers.parquet_or_empty(spark, f"{base}/registry", REGISTRY)
        intake.gate(wave, "doc_id", known).drop("text").write.parquet(f"{base}/verdicts/wave={number}")
        gated = spark.read.parquet(f"{base}/verdicts/wave={number}")
        texts = intake.candidates(wave)
        stored = PrefixedTable(spark, f"{base}/documents", texts.schema, "report_id", fan_in=2)
        stored.put(texts, number, among=intake.accepted_documents(gated))
        writers.append_registry(intake.new_hashes(gated), f"{base}/registry")
    return stored.read()


@query
def report_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One text file per document, read whole; the writer ends each with a line break."""
    path = scratch_dir(spark, "report-files")
    writers.write_reports(table(spark, sf_dir, "documents"), path, folder="doc_id")
    return readers.read_reports(spark, path, folder="doc_id")


@query
def upload_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Upload bodies as JSON lines, among them the raw pages, which are no JSON."""
    path = scratch_dir(spark, "uploads")
    bodies = _uploads(spark, sf_dir).select(F.to_json(F.struct("report_id", "text")).alias("value"))
    raw = table(spark, sf_dir, "pages").select(
        F.concat(F.lit("PAGE "), F.regexp_replace("html", r"[\r\n]", " ")).alias("value")
    )
    bodies.unionByName(raw).write.text(path)
    checked = intake.checked(readers.read_uploads(spark, path))
    return checked.groupBy("error").agg(
        F.count("*").alias("n_uploads"), F.countDistinct("content_hash").alias("n_texts")
    )


@query
def labelled_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_dir(spark, "labelled")
    writers.write_labelled(derived.labelled(table(spark, sf_dir, "orders")), path)
    read = readers.read_labelled(spark, f"{path}/labels", array_file=False)
    return readers.flat_truth(read)


@query
def occurrence_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write the occurrence table, then query it by name as a served view."""
    path = scratch_dir(spark, "occurrences")
    writers.write_occurrences(_valid_records(spark, sf_dir), path)
    readers.view(spark, f"{path}/occurrences", "docfacts_occurrences")
    return spark.sql(
        "SELECT mineral, lat_bucket, lon_bucket, n_reports FROM docfacts_occurrences"
    )


def _survey(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """From uploads to regions on one set of texts, each stage reading what the one before left;
    and the checks of the run, measured as its stages are written.

    Every report is sent twice, the second time under another id. The verdicts are kept without the
    texts, which are shuffled once to be put and once to meet their passages; what a job shuffled goes with it.
    """
    with shuffles_let_go(spark):
        counted, checks = _survey_stages(spark, sf_dir)
    return resolve.by_region(spark.table("docfacts_run")).withColumns(counted), checks


def _survey_stages(spark: SparkSession, sf_dir: str) -> tuple[dict[str, Column], DataFrame]:
    """Run and write the stages; what was counted in them, and the checks."""
    base, suite, check = scratch_dir(spark, "survey-run"), quality.Suite(spark), quality.Measure
    status = F.col("status")
    sent = derived.reports(derived.spread(table(spark, sf_dir, "orders")))
    again = sent.withColumn("report_id", F.concat(F.lit("again-"), "report_id"))
    uploads = sent.unionByName(again)
    gated = suite.stage(
        intake.gate(uploads, "report_id").drop("text"),
        check("completeness", "share_of_uploads_with_a_verdict", _share(F.count("status"), F.count("*")), 1.0),
        check("validity", "share_of_uploads_let_in", _share(F.count_if(status == intake.ACCEPTED), F.count("*")), 0.5,
              higher_is_better=False),
    )
    writers.write_stage(gated, f"{base}/verdicts")
    gated = spark.read.parquet(f"{base}/verdicts")
    texts = intake.candidates(uploads)
    documents = PrefixedTable(spark, f"{base}/documents", texts.schema, "report_id")
    hashed = {"content_hash": intake.content_hash(F.col("text"))}
    documents.put(texts, 0, among=intake.accepted_documents(gated), computed=hashed)
    writers.append_registry(intake.new_hashes(gated), f"{base}/registry")

    reports = documents.read().select("report_id", "text")
    encoder = retrieve.TermEncoder().fit(chunk.chunk(reports))
    found = retrieve.retrieve(reports, encoder, retrieve.encode_query(reports, encoder))
    failed = status == extract.FAILED
    used_up = F.col("attempts") == extract.MAX_ATTEMPTS
    outcomes = suite.stage(
        extract.run(found, extract.provider("rules")),
        check("correctness", "share_of_failures_after_all_attempts",
              _share(F.count_if(failed & used_up), F.count_if(failed)), 1.0),
        check("completeness", "share_of_reports_extracted", _share(F.count_if(~failed), F.count("*")), 0.75),
    )
    writers.write_stage(outcomes, f"{base}/outcomes")
    outcomes = spark.read.parquet(f"{base}/outcomes")
    log = extract.attempt_log(outcomes)
    writers.append_attempts(log, f"{base}/attempts")
    records = outcomes.filter(F.col("status") == extract.EXTRACTED).select("report_id", "record.*")
    stored = PrefixedTable(spark, f"{base}/extractions", records.schema, "report_id")
    stored.put(records, 0)

    with suite.timed("seconds_to_resolve", RESOLVE_SECONDS):
        writers.write_occurrences(stored.read(), f"{base}/served")
    readers.view(spark, f"{base}/served/occurrences", "docfacts_run")
    denied = spark.read.schema(log.schema).parquet(f"{base}/attempts").filter("NOT allowed").count()
    known = spark.read.schema(REGISTRY).parquet(f"{base}/registry").count()
    return {"n_denied": F.lit(denied).cast("long"), "n_texts": F.lit(known).cast("long")}, suite.checks()


@query
def survey_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _survey(spark, sf_dir)[0]


@query
def survey_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The checks of the run; how many seconds it took is not shown, only whether too many."""
    checks = _survey(spark, sf_dir)[1]
    shown = F.when(F.col("dimension") != "timeliness", F.round("measured", 6))
    return checks.select("dimension", "name", shown.alias("measured"), "passed")


@query
def missing_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table that was never written serves as an empty view beside the records."""
    readers.view(spark, scratch_dir(spark, "never-written"), "docfacts_missing")
    known = _occurrences(spark, sf_dir).select("mineral", "n_reports")
    served = spark.sql("SELECT mineral, n_reports FROM docfacts_missing")
    return known.unionByName(served).groupBy("mineral").agg(F.sum("n_reports").alias("n_reports"))


# --- evaluation and quality --------------------------------------------------------


def _matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    truth = derived.truth(table(spark, sf_dir, "orders"))
    return evaluate.field_matches(_outcomes(spark, sf_dir), truth)


@query
def eval_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    matches = _matches(spark, sf_dir)
    return matches.select("report_id", "status", "attempts", "field_matches.*")


@query
def eval_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return evaluate.summary(_matches(spark, sf_dir))


@query
def evaluation_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_dir(spark, "evaluation")
    matches = _matches(spark, sf_dir)
    writers.write_evaluation(matches, path)
    schema = "report_id string, status string, attempts int, field_matches struct<" + (
        ", ".join(f"{f}: boolean" for f in RECORD_FIELDS) + ">"
    )
    read = spark.read.schema(schema).json(f"{path}/results")
    return read.select("report_id", "status", "attempts", "field_matches.*")


def _share(part: F.Column, whole: F.Column) -> F.Column:
    """Null, which passes no check, where there was nothing to measure."""
    return F.round(F.try_divide(part, whole), 6)


def _checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Checks of every stage, each stage measured in one pass."""
    status = F.col("status")
    short = F.octet_length("text") < intake.MIN_TEXT_BYTES
    # Uploads per text; those without a hash, the rejected ones, form one group.
    copies = (
        intake.gate(_uploads(spark, sf_dir), "doc_id")
        .groupBy("content_hash")
        .agg(
            F.count("*").alias("n"),
            F.count_if(status == intake.ACCEPTED).alias("accepted"),
            F.count_if(status == intake.DUPLICATE).alias("duplicate"),
            F.count_if(status == intake.REJECTED).alias("rejected"),
            F.count_if(short).alias("short"),
            F.count_if(short & (status == intake.REJECTED)).alias("short_rejected"),
        )
    )
    hashed, again = F.col("content_hash").isNotNull(), F.col("n") > 1
    others_out = F.col("duplicate") == F.col("n") - 1
    with_status = F.col("accepted") + F.col("duplicate") + F.col("rejected")
    checked = validate.check(_records(spark, sf_dir))
    outside = ~F.col("lat").between(*validate.LAT_BOUNDS)
    failed = status == extract.FAILED
    used_up = F.col("attempts") == extract.MAX_ATTEMPTS
    correct = sum((F.col("field_matches")[f].cast("int") for f in RECORD_FIELDS), F.lit(0))
    everything, fields = F.count("*"), F.count("*") * len(RECORD_FIELDS)
    check = quality.Measure
    return quality.evaluate(
        [
            quality.measure(
                copies,
                check(
                    "validity",
                    "share_of_texts_accepted_once",
                    _share(F.count_if(hashed & (F.col("accepted") == 1)), F.count_if(hashed)),
                    1.0,
                ),
                check(
                    "validity",
                    "share_of_repeated_texts_with_one_in",
                    _share(F.count_if(hashed & again & others_out), F.count_if(hashed & again)),
                    1.0,
                ),
                check(
                    "validity",
                    "share_of_short_uploads_rejected",
                    _share(F.sum("short_rejected"), F.sum("short")),
                    1.0,
                ),
                check(
                    "completeness",
                    "share_of_uploads_with_a_verdict",
                    _share(F.sum(with_status), F.sum("n")),
                    1.0,
                ),
            ),
            quality.measure(
                checked,
                check(
                    "validity",
                    "share_of_outside_latitudes_invalid",
                    _share(F.count_if(outside & ~F.col("valid")), F.count_if(outside)),
                    1.0,
                ),
            ),
            quality.measure(
                _matches(spark, sf_dir),
                check(
                    "correctness",
                    "share_of_failures_after_all_attempts",
                    _share(F.count_if(failed & used_up), F.count_if(failed)),
                    1.0,
                ),
                check(
                    "correctness",
                    "share_of_fields_as_labelled",
                    F.round(F.sum(correct) / fields, 4),
                    0.99,
                ),
                check(
                    "completeness",
                    "reports_lost_to_failed_extraction",
                    _share(F.count_if(failed), everything),
                    0.25,
                    higher_is_better=False,
                ),
            ),
            quality.measure(
                _occurrences(spark, sf_dir),
                check(
                    "consistency",
                    "reports_of_the_largest_site",
                    F.max("n_reports"),
                    2.0,
                    detail="reports of the most reported site",
                ),
            ),
        ]
    )


@query
def quality_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _checks(spark, sf_dir)


@query
def quality_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.score(_checks(spark, sf_dir))


@query
def quality_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.counts(_checks(spark, sf_dir))


@query
def quality_failed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.failed(_checks(spark, sf_dir)).select("dimension", "name", "measured")


@query
def quality_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_dir(spark, "quality")
    writers.write_quality(_checks(spark, sf_dir), path)
    return spark.read.schema("dimension string, score double").json(f"{path}/score")


# --- generators --------------------------------------------------------------------


@query
def synth_reports(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A labelled report for every order key."""
    labelled = synth.label(table(spark, sf_dir, "orders"), "o_orderkey")
    return readers.flat_truth(labelled)


@query
def synth_skew(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A customer for every event, 5 % of the customers being hot."""
    n_customers = table(spark, sf_dir, "customer").agg(F.count("*")).scalar()
    events = table(spark, sf_dir, "events").select("event_id")
    return synth.skewed_index(events, n_customers, "event_id")
