"""Every operator as a query over the test tables: name -> (spark, folder) -> DataFrame.

tables; the documents table is the corpus.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tomeworks.functions import fields, hashing, markup, text
from tomeworks.operators import audit, boilerplate, datasets, eligibility, folds, metrics
from tomeworks.operators import subjects as subj
from tomeworks.operators import terms, vectors, vocabulary, weights
from tomeworks.plans import experiments, inputs
from tomeworks.plans.corpus_audit import audit as corpus_audit
from tomeworks.plans.eligible_corpus import eligible_corpus
from tomeworks.plans.experiments import Examples
from tomeworks.plans.features import Features, Settings
from tomeworks.plans.resumed_audit import AuditLog
from tomeworks.plans.subject_metadata import subject_metadata
from tomeworks.sources import corpus, listing, manifest, metadata, sinks, tables
from tomeworks.sources.key_index import Layout
from tomeworks.sources.versions import RunTable, VersionedTable
from tomeworks.staging import last_change, stage, stage_path, still_staged
from tomeworks.streaming import arriving_vectors, running_df

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

_BATCHES = 4  # of the streams
_IDF_CAP = 100  # documents that take part in the capped runs
TF_SIZES = (10_000, 8_000, 6_000)
_REGRESSION_SLACK = 0.05  # by which a regression may fall short of the majority share
_FEATURES: dict[tuple, Features] = {}
_STAGED: dict[tuple, tuple] = {}


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def _version(spark: SparkSession, folder: str) -> tuple:
    """Names the data of a folder, so that replaced data is noticed."""
    used = ("documents", "labels", "embeddings")
    return (spark.sparkContext.applicationId, folder, *(last_change(spark, f"{folder}/{t}.parquet") for t in used))


def _features(spark: SparkSession, folder: str, settings: Settings = Settings()) -> Features:
    """Feature tables are staged once per session and shared by the queries."""
    key = (*_version(spark, folder), settings)
    known = _FEATURES.get(key)
    if known is None or not all(still_staged(df) for df in known.staged()):
        made = _FEATURES[key] = Features(inputs.corpus(spark, folder), settings)
        # the counts of terms do not depend on how they are weighted and hashed
        counted = [f for (*version, s), f in _FEATURES.items() if tuple(version) == key[:-1] and s.counting == settings.counting]
        made.__dict__.update(next(({"bags": f.bags} for f in counted if "bags" in f.__dict__ and still_staged(f.bags)), {}))
    return _FEATURES[key]


def _once(spark: SparkSession, folder: str, name: str, make: Callable[[], tuple]) -> tuple:
    """What ``make`` returns, a tuple that begins with a stage table, made once per session."""
    key = (*_version(spark, folder), name)
    if key not in _STAGED or not still_staged(_STAGED[key][0]):
        _STAGED[key] = make()
    return _STAGED[key]


def _manifest(spark: SparkSession, folder: str) -> DataFrame:
    def make() -> tuple:
        return (stage(_features(spark, folder).manifest(inputs.metadata(spark, folder)), "manifest"),)

    return _once(spark, folder, "manifest", make)[0]


def _examples(
    spark: SparkSession,
    folder: str,
    plan: str = "7/2/1",
    weighting: str = "tfidf",
    settings: Settings = Settings(),
) -> Examples:
    def make() -> tuple:
        names = subj.top_names(subj.subject_frequency(_manifest(spark, folder)))
        made = experiments.examples_of(_features(spark, folder, settings), _manifest(spark, folder), names, plan, weighting)
        return made.rows, made

    return _once(spark, folder, f"examples-{plan}-{weighting}-{settings}", make)[1]


def _tf_examples(spark: SparkSession, folder: str, buckets: int) -> Examples:
    """The TF runs: split 4/3/3, several vector sizes from one table of bags."""

    def make() -> tuple:
        names = subj.top_names(subj.subject_frequency(_manifest(spark, folder)))
        vecs = vectors.bag_vectors(_features(spark, folder).bags, buckets)
        rows = stage(datasets.training_set(vecs, _manifest(spark, folder), names, "4/3/3"), "examples")
        return rows, Examples(rows, names, buckets, "tf")

    return _once(spark, folder, f"tf-examples-{buckets}", make)[1]


def _predictions(spark: SparkSession, folder: str, plan: str = "7/2/1") -> DataFrame:
    def make() -> tuple:
        return (stage(experiments.naive_bayes_predictions(_examples(spark, folder, plan)), "predictions"),)

    return _once(spark, folder, f"predictions-{plan}", make)[0]


def _statuses(spark: SparkSession, folder: str) -> DataFrame:
    def make() -> tuple:
        files = inputs.marked(spark, folder).select("seq", "file", "text")
        return (stage(corpus_audit(files, inputs.metadata_keys(spark, folder)), "audit"),)

    return _once(spark, folder, "audit", make)[0]


def _text_statuses(spark: SparkSession, folder: str) -> DataFrame:
    """Duplicates by whole text: the key is the text's digest."""

    def make() -> tuple:
        docs = inputs.documents(spark, folder).select("doc_id", F.md5("text").alias("doc_key"))
        keyed = stage(docs.select(F.col("doc_id").alias("seq"), "doc_key"), "digests")
        labelled = tables.read_table(spark, folder, "labels").select("doc_id")
        known = docs.join(labelled, "doc_id", "left_semi").select("doc_key")
        return (stage(audit.file_statuses(keyed, known), "text-statuses"),)

    return _once(spark, folder, "text-statuses", make)[0]


def _rounded(df: DataFrame, *columns: str, digits: int = 6) -> DataFrame:
    return df.withColumns({c: F.round(c, digits) for c in columns})


# --- sources -----------------------------------------------------------------


@query
def s1_corpus_text(spark, folder):
    docs = inputs.documents(spark, folder)
    return docs.select(
        "doc_id",
        F.length("text").cast("bigint").alias("n_chars"),
        (markup.count_breaks(F.col("text")) + 1).cast("bigint").alias("n_lines"),
    )


@query
def s2_recursive_text_files(spark, folder):
    """Whole text files in sub-folders, next to files of another kind.

    The fixture writes a folder per source and many documents to a file, each
    followed by a line break; the sums per folder show that every file is read once and whole.
    """
    path = stage_path(spark, "files")
    docs = inputs.documents(spark, folder).select("source", F.col("text").alias("value"))
    docs.write.partitionBy("source").option("maxRecordsPerFile", 1000).text(path)
    tables.read_table(spark, folder, "labels").write.mode("append").csv(path)
    files = corpus.text_documents(spark, path, "*.txt*")
    source = F.regexp_extract("path", "source=([^/]*)/", 1)
    return files.groupBy(source.alias("source")).agg(
        F.sum(F.length("text")).alias("n_chars"), F.sum(markup.count_breaks(F.col("text"))).alias("n_lines")
    )


@query
def s3_lines_with_partition_hint(spark, folder):
    path = stage_path(spark, "lines")
    inputs.documents(spark, folder).select("text").write.text(path)
    lines = corpus.text_lines(spark, path, at_least=10)
    return lines.groupBy(F.length("value").cast("bigint").alias("n_chars")).agg(F.count("*").alias("n_lines"))


@query
def s4_manifest_lines(spark, folder):
    path = stage_path(spark, "manifest-lines")
    sinks.save_manifest_lines(_manifest(spark, folder), path)
    parsed = manifest.parse_manifest(corpus.text_lines(spark, path))
    return parsed.select(
        "doc_id", "file", "fold", F.concat_ws("|", "subjects").alias("subjects")
    )


@query
def s5_xml_metadata(spark, folder):
    parsed = metadata.usable(metadata.parse_metadata(inputs.xml_records(spark, folder)))
    return parsed.select("doc_id", F.posexplode("subjects").alias("pos", "subject"))


@query
def s5_many_record_files(spark, folder):
    """The records again, read from files that hold many of them."""
    path = stage_path(spark, "record-files")
    inputs.many_record_files(spark, folder, path)
    parsed = metadata.parse_metadata(metadata.metadata_records(spark, path, "*.txt", "p:ebook"))
    return metadata.usable(parsed).select("doc_id", F.posexplode("subjects").alias("pos", "subject"))


@query
def s6_saved_features(spark, folder):
    path = stage_path(spark, "saved-tf")
    sinks.save_table(_features(spark, folder).tf, path)
    tf = tables.read_features(spark, path).where(F.col("tf") == 1.0)
    return tf.groupBy("doc_id").agg(F.count("*").alias("n_top"), F.min("term").alias("first_top"))


@query
def s7_directory_listing(spark, folder):
    return _rounded(listing.parse_listing(inputs.listing_lines(spark, folder)), "size_mb")


@query
def s7_file_sizes(spark, folder):
    """Bytes below each folder as the file system has them; the texts are not read."""
    path = stage_path(spark, "sized-files")
    docs = inputs.documents(spark, folder).select("source", F.col("text").alias("value"))
    docs.write.partitionBy("source").option("maxRecordsPerFile", 1000).text(path)
    source = F.regexp_extract("path", "source=([^/]*)/", 1)
    return listing.file_sizes(spark, path).groupBy(source.alias("source")).agg(F.sum("size").alias("n_bytes"))


@query
def s8_in_memory_names(spark, folder):
    """A short list from code joined to the corpus: how often each function word occurs."""
    words = tables.names_table(spark, text.FUNCTION_WORDS, "token")
    tokens = inputs.corpus(spark, folder).select(
        F.explode(text.split_words(F.col("text"))).alias("token")
    ).select(text.fold_case(F.col("token")).alias("token"))
    return tokens.join(F.broadcast(words), "token").groupBy("token").agg(F.count("*").alias("n"))


@query
def s9_fold_folders(spark, folder):
    path = stage_path(spark, "folds")
    vecs = _features(spark, folder).vectors().join(_manifest(spark, folder).select("doc_id", "fold"), "doc_id")
    sinks.save_by_fold(vecs, path)
    return tables.read_features(spark, path, folds=[7, 8, 9]).select(
        "doc_id", "fold", F.size("vec").cast("bigint").alias("n_buckets")
    )


# --- sinks -------------------------------------------------------------------


@query
def k1_tf_table(spark, folder):
    path = stage_path(spark, "tf")
    sinks.save_table(_features(spark, folder).tf, path)
    return tables.read_features(spark, path).groupBy("doc_id").agg(
        F.count("*").alias("n_terms"), F.sum("n").alias("n_tokens")
    )


@query
def k1_versioned_tf(spark, folder):
    """Written twice; the second version replaces the first."""
    table = VersionedTable(spark, stage_path(spark, "versions"))
    tf = _features(spark, folder).tf
    table.write(tf.where("doc_id % 2 = 0"))
    table.write(tf)
    return table.read().groupBy("doc_id").agg(F.count("*").alias("n_terms"), F.sum("n").alias("n_tokens"))


@query
def k2_run_manifest(spark, folder):
    path = stage_path(spark, "manifest")
    sinks.save_manifest_lines(_manifest(spark, folder), path)
    return corpus.text_lines(spark, path).select(F.col("value").alias("line"))


@query
def k3_idf_manifest(spark, folder):
    """The manifest of the documents that went into a capped run, with the final comma."""
    path = stage_path(spark, "idf-manifest")
    used = eligibility.first_documents(_manifest(spark, folder), _IDF_CAP)
    sinks.save_manifest_lines(used, path, trailing_comma=True)
    return corpus.text_lines(spark, path).select(F.col("value").alias("line"))


@query
def k4_frequency_tables(spark, folder):
    """Raw document frequencies are kept, so IDF can be made again with or without the logarithm."""
    features = _features(spark, folder)
    raw, final = stage_path(spark, "df"), stage_path(spark, "idf")
    sinks.save_table(vocabulary.document_frequency(features.bags), raw)
    again = weights.inverse_frequency(tables.read_features(spark, raw), features.n_docs, log=True)
    sinks.save_table(again, final)
    return _rounded(tables.read_features(spark, final), "idf")


@query
def k5_fold_partitioned_vectors(spark, folder):
    path = stage_path(spark, "vectors")
    vecs = _features(spark, folder).vectors().join(_manifest(spark, folder).select("doc_id", "fold"), "doc_id")
    sinks.save_by_fold(vecs, path)
    entries = tables.read_features(spark, path).select("fold", "doc_id", F.inline("vec"))
    return _rounded(entries.select("fold", "doc_id", "bucket", "w"), "w")


@query
def k6_metadata_csv(spark, folder):
    """Records that are unreadable or have no id are counted, the others written and read back."""
    records = inputs.xml_records(spark, folder, broken_every=17, nameless_every=19)
    parsed = stage(metadata.with_outcome(metadata.parse_metadata(records)), "metadata")
    path = stage_path(spark, "metadata-csv")
    lines = metadata.usable(parsed).select(
        fields.prefixed_record(F.col("doc_id"), F.col("subjects")).alias("value")
    )
    sinks.save_csv(lines, path)
    written = spark.read.option("header", "true").option("escape", '"').schema("value string").csv(path)
    good = written.select(F.lit("written").alias("outcome"), F.length("value").cast("bigint").alias("size"))
    bad = parsed.where("outcome <> 'read'").select("outcome", F.lit(0).cast("bigint").alias("size"))
    return good.unionByName(bad).groupBy("outcome").agg(F.count("*").alias("n"), F.sum("size").alias("n_chars"))


@query
def k7_subject_counts(spark, folder):
    path = stage_path(spark, "subject-counts")
    sinks.save_table(subj.subject_frequency(inputs.metadata(spark, folder)), path)
    return spark.read.parquet(path)


@query
def k8_status_table(spark, folder):
    """Written in two runs, the second appending to the first."""
    path = stage_path(spark, "status")
    statuses = _statuses(spark, folder)
    sinks.save_table(statuses.where(F.col("seq") % 2 == 0), path)
    sinks.append_table(statuses.where(F.col("seq") % 2 != 0), path)
    return spark.read.parquet(path).select("file", "doc_key", "status", "fold")


@query
def k8_resumed_audit(spark, folder):
    """The files arrive in three runs; each audits its own, against the ids stored before."""
    files = inputs.marked(spark, folder)
    last = files.agg(F.max("seq")).first()[0] or 0
    log = AuditLog(spark, stage_path(spark, "audit-log"), Layout(buckets=8, words=256))
    for run in range(3):
        part = files.where(F.col("seq").between(run * last // 3 + (run > 0), (run + 1) * last // 3))
        log.audit(part, inputs.metadata_keys(spark, folder), f"run-{run}")
    return log.statuses().select("file", "doc_key", "status", "fold")


@query
def k9_exclusion_list(spark, folder):
    path = stage_path(spark, "exclusions")
    big = listing.big_files(listing.parse_listing(inputs.listing_lines(spark, folder)))
    sinks.save_csv(listing.exclusion_records(big), path)
    schema = "reason string, file string, size_text string"
    return spark.read.option("header", "true").schema(schema).csv(path)


@query
def k10_metrics_table(spark, folder):
    path = stage_path(spark, "metrics")
    scored = metrics.accuracy(_predictions(spark, folder), "subject", "split")
    for split in experiments.SPLITS:
        sinks.append_table(scored.where(F.col("split") == split), path)
    return _rounded(spark.read.parquet(path), "accuracy")


@query
def k10_metrics_runs(spark, folder):
    """A run for each part; each is tried twice and counts once."""
    table = RunTable(spark, stage_path(spark, "runs"))
    scored = metrics.accuracy(_predictions(spark, folder), "subject", "split")
    for split in [*experiments.SPLITS, *experiments.SPLITS]:
        table.add(split, lambda split=split: scored.where(F.col("split") == split))
    return _rounded(table.read().select("run", "subject", "split", "n_docs", "accuracy"), "accuracy")


@query
def k10_vector_stats(spark, folder):
    """Appended per run; here one run."""
    path = stage_path(spark, "vector-stats")
    sinks.append_table(_features(spark, folder).vector_stats(_manifest(spark, folder)), path)
    return spark.read.parquet(path)


# --- projections and filters -------------------------------------------------


@query
def f1_document_id(spark, folder):
    docs = inputs.marked(spark, folder)
    return docs.select("doc_id", markup.document_id(F.col("text")).alias("book_id"))


@query
def f2_header_line(spark, folder):
    docs = inputs.marked(spark, folder)
    return docs.select("doc_id", markup.header_line(F.col("text")).cast("bigint").alias("header_line"))


@query
def f3_header_strip(spark, folder):
    stripped = boilerplate.strip_boilerplate(inputs.marked(spark, folder), footers=[])
    return stripped.select("doc_id", F.md5("text").alias("body_md5"))


@query
def f4_footer_line(spark, folder):
    docs = inputs.marked(spark, folder)
    return docs.select("doc_id", markup.footer_line(F.col("text")).cast("bigint").alias("footer_line"))


@query
def f5_footer_strip(spark, folder):
    stripped = boilerplate.strip_boilerplate(inputs.marked(spark, folder))
    return stripped.select("doc_id", F.md5("text").alias("body_md5"))


@query
def f6_body_lines(spark, folder):
    lines = boilerplate.body_lines(boilerplate.strip_boilerplate(inputs.marked(spark, folder)))
    return lines.select("doc_id", F.col("line_no").cast("bigint"), F.md5("line").alias("line_md5"))


@query
def f7_token_cleaning(spark, folder):
    each = inputs.corpus(spark, folder).select(F.explode(text.terms(F.col("text"))).alias("term"))
    return each.groupBy("term").agg(F.count("*").alias("n"))


@query
def f8_good_files(spark, folder):
    files = inputs.documents(spark, folder).selectExpr("doc_id", f"{inputs.FILE_NAME} AS file")
    # some files are listed twice and must be skipped
    listed = _statuses(spark, folder).select("file", "status")
    twice = listed.join(files.where("doc_id % 29 = 1"), "file", "left_semi")
    return eligibility.good_files(files, listed.unionByName(twice)).select("doc_id", "file")


@query
def f9_exclusion_list(spark, folder):
    files = inputs.documents(spark, folder).selectExpr("doc_id", f"{inputs.FILE_NAME} AS file")
    big = listing.big_files(listing.parse_listing(inputs.listing_lines(spark, folder))).select("file")
    by_hand = tables.names_table(spark, eligibility.HAND_PICKED_EXCLUSIONS)
    return eligibility.without_excluded(files, big.unionByName(by_hand)).select("doc_id", "file")


@query
def f10_size_filter(spark, folder):
    """Oversize files, and whether the reference's size rule (M only) finds them too."""
    lines = inputs.listing_lines(spark, folder)
    big = listing.big_files(listing.parse_listing(lines)).select("file", "size_text")
    only_m = listing.big_files(listing.parse_listing(lines, reference_compat=True))
    flagged = only_m.select("file", F.lit(True).alias("by_m_only"))
    return big.join(flagged, "file", "left").select(
        "file", "size_text", F.coalesce("by_m_only", F.lit(False)).alias("by_m_only")
    )


@query
def f11_txt_lines(spark, folder):
    lines = inputs.listing_lines(spark, folder)
    return listing.parse_listing(lines).agg(F.count("*").alias("n_txt"))


@query
def f12_document_cap(spark, folder):
    docs = inputs.documents(spark, folder).select("doc_id", "n_chars")
    return eligibility.first_documents(docs, _IDF_CAP)


@query
def f13_fold_filter(spark, folder):
    return tables.in_folds(_manifest(spark, folder), [0, 1, 2, 3]).select("doc_id", "fold")


@query
def f14_non_empty(spark, folder):
    tokens = inputs.corpus(spark, folder).select(
        "doc_id", F.explode(text.split_words(F.col("text"))).alias("token")
    )
    return eligibility.non_empty(tokens, "token").groupBy("doc_id").agg(F.count("*").alias("n_tokens"))


@query
def f15_subject_label(spark, folder):
    docs = inputs.metadata(spark, folder)
    return docs.select("doc_id", subj.has_subject("quality:1").alias("label"))


@query
def f16_rescale(spark, folder):
    rows = _features(spark, folder).tfidf
    return _rounded(rows.select("doc_id", "term", "tf", "idf", "tfidf"), "idf", "tfidf")


@query
def f17_listing_projection(spark, folder):
    files = listing.parse_listing(inputs.listing_lines(spark, folder))
    return files.select(F.concat_ws(",", "file", "size_text").alias("record"))


@query
def f18_id_normalisation(spark, folder):
    docs = inputs.documents(spark, folder)
    about = F.concat(F.lit("ebooks/"), F.col("doc_id").cast("string"))
    return docs.select(
        "doc_id",
        fields.ebook_id(about).alias("from_about"),
        fields.digits(F.concat(F.lit(" ID="), F.col("doc_id").cast("string"))).alias("from_record"),
        fields.digits(F.expr(inputs.FILE_NAME)).alias("from_file"),
    )


# --- joins -------------------------------------------------------------------


@query
def j1_tf_idf_join(spark, folder):
    features = _features(spark, folder)
    rows = weights.tfidf(features.tf, features.idf)
    return _rounded(rows.select("doc_id", "term", "tf", "idf"), "idf")


@query
def j2_file_status_lookup(spark, folder):
    files = inputs.documents(spark, folder).selectExpr("doc_id", f"{inputs.FILE_NAME} AS file")
    return eligibility.listed_once(files, _statuses(spark, folder)).select("doc_id", "file", "status")


@query
def j3_metadata_lookup(spark, folder):
    labels = tables.read_table(spark, folder, "labels")
    docs = inputs.documents(spark, folder).select("doc_id", "lang")
    return subj.with_metadata(docs, labels).select("doc_id", "lang", "quality", "toxic")


@query
def j4_metadata_exists(spark, folder):
    docs = inputs.documents(spark, folder).select("doc_id")
    labels = tables.read_table(spark, folder, "labels")
    known = audit.with_known_metadata(docs, labels, "doc_id").withColumn("known", F.lit(True))
    unknown = audit.without_metadata(docs, labels, "doc_id").withColumn("known", F.lit(False))
    return known.unionByName(unknown)


@query
def j5_duplicate_ids(spark, folder):
    statuses = _statuses(spark, folder).where(F.col("status") == "DUPLICATE")
    return statuses.select("seq", "doc_key")


@query
def j6_manifest_vectors(spark, folder):
    rows = _manifest(spark, folder).select("doc_id", "fold").join(_features(spark, folder).tf_buckets, "doc_id")
    return _rounded(rows, "w")


@query
def j7_label_prediction_rows(spark, folder):
    return _predictions(spark, folder).select("doc_id", "subject", "label", "prediction")


@query
def j8_docs_by_subject(spark, folder):
    return subj.one_vs_rest(_manifest(spark, folder), _examples(spark, folder).names, "fold")


# --- aggregations ------------------------------------------------------------


@query
def a1_term_counts(spark, folder):
    return terms.term_counts(_features(spark, folder).bags)


@query
def a2_max_term_count(spark, folder):
    return _features(spark, folder).bags.where(F.col("max_n").isNotNull()).select("doc_id", "max_n")


@query
def a3_document_frequency(spark, folder):
    return vocabulary.document_frequency(_features(spark, folder).bags)


@query
def a4_merged_frequencies(spark, folder):
    """Document frequencies of two halves of the corpus, merged."""
    bags = _features(spark, folder).bags
    halves = [bags.where(F.pmod("doc_id", F.lit(2)) == h) for h in (0, 1)]
    return vocabulary.merge_frequencies(*[vocabulary.document_frequency(h) for h in halves])


@query
def a5_document_count(spark, folder):
    return _features(spark, folder).n_docs


@query
def a6_subject_frequency(spark, folder):
    """Of the run, that is of the documents in the manifest."""
    return subj.subject_frequency(_manifest(spark, folder))


def _metadata_records(spark, folder):
    return inputs.metadata(spark, folder).select(
        fields.prefixed_record(F.col("doc_id"), F.col("subjects")).alias("value")
    )


@query
def a7_metadata_terms(spark, folder):
    return subj.field_frequency(_metadata_records(spark, folder), keep_ids=True)


@query
def a8_status_histogram(spark, folder):
    return audit.status_counts(_statuses(spark, folder))


@query
def a9_audit_totals(spark, folder):
    return audit.audit_totals(_statuses(spark, folder))


@query
def a10_bucket_sums(spark, folder):
    return _rounded(_features(spark, folder).tf_buckets, "w")


@query
def a11_confusion_counts(spark, folder):
    return metrics.confusion(_predictions(spark, folder), "subject", "split")


@query
def a12_accuracy(spark, folder):
    return _rounded(metrics.accuracy(_predictions(spark, folder), "subject", "split"), "accuracy")


MEASURES = ["error_rate", "accuracy", "recall", "precision", "specificity"]


@query
def a13_binary_metrics(spark, folder):
    counts = metrics.confusion(_predictions(spark, folder), "subject", "split")
    return _rounded(metrics.binary_metrics(counts, "subject", "split"), *MEASURES)


@query
def a14_vocabulary_counts(spark, folder):
    grown = vocabulary.vocabulary_growth(_features(spark, folder).bags)
    return grown.select("doc_id", "words", "already", "new")


@query
def a15_split_sizes(spark, folder):
    return folds.split_sizes(_examples(spark, folder).rows)


@query
def a16_row_counts(spark, folder):
    lines = inputs.listing_lines(spark, folder)
    counts = [
        ("documents", inputs.documents(spark, folder)),
        ("metadata", inputs.metadata(spark, folder)),
        ("listing", listing.parse_listing(lines)),
        ("oversize", listing.big_files(listing.parse_listing(lines))),
    ]
    parts = [df.agg(F.count("*").alias("n")).select(F.lit(name).alias("what"), "n") for name, df in counts]
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result


# --- windows -----------------------------------------------------------------


@query
def w1_cyclic_folds(spark, folder):
    return folds.cyclic_folds(inputs.documents(spark, folder))


@query
def w1_hashed_folds(spark, folder):
    return inputs.documents(spark, folder).select("doc_id", folds.hashed_fold(F.col("doc_id")).alias("fold"))


@query
def w2_first_copy_status(spark, folder):
    return _text_statuses(spark, folder).select("seq", "doc_key", "status")


@query
def w3_vocabulary_growth(spark, folder):
    return vocabulary.vocabulary_growth(_features(spark, folder).bags).select("doc_id", "new", "vocabulary")


@query
def w4_max_normalised(spark, folder):
    """The window form, on counted rows; gives what the row-local form gives."""
    counts = terms.term_counts(_features(spark, folder).bags)
    largest = F.max("n").over(Window.partitionBy("doc_id"))
    return counts.select("doc_id", "term", (F.col("n") / largest).alias("tf"))


@query
def p1_eligible_corpus(spark, folder):
    """The main run from its files: id from the text, audit, exclusion, header and footer cut."""
    files = inputs.marked(spark, folder).select(F.expr(inputs.PATH).alias("path"), "file", "text")
    big = listing.big_files(listing.parse_listing(inputs.listing_lines(spark, folder))).select("file")
    exclusions = big.unionByName(tables.names_table(spark, eligibility.HAND_PICKED_EXCLUSIONS))
    docs = eligible_corpus(files, inputs.metadata_keys(spark, folder), exclusions)
    return docs.select("doc_id", F.md5("text").alias("body_md5"))


# --- sort and limit ----------------------------------------------------------


@query
def o1_top_subjects_of_run(spark, folder):
    return subj.top(subj.subject_frequency(_manifest(spark, folder)), 10)


@query
def s5_metadata_ranking(spark, folder):
    """The whole metadata job: records with some unreadable ones, to a ranking of subjects."""
    return subject_metadata(inputs.xml_records(spark, folder, broken_every=17)).ranking


@query
def o2_subject_ranking(spark, folder):
    ranking = subj.ranked(subj.field_frequency(_metadata_records(spark, folder)), "term")
    return ranking


@query
def o2_top_14_terms(spark, folder):
    return subj.top(subj.field_frequency(_metadata_records(spark, folder), keep_ids=False), 14, "term")


@query
def o3_sample_rows(spark, folder):
    rows = _rounded(_features(spark, folder).tfidf.select("doc_id", "term", "tfidf"), "tfidf")
    return rows.orderBy("doc_id", "term").limit(10)


# --- set operations ----------------------------------------------------------


def _vocabulary_parts(spark, folder):
    """Terms of the arriving documents (odd ids) and the vocabulary so far (even ids)."""
    bags = _features(spark, folder).bags
    arriving = terms.term_counts(bags.where(F.pmod("doc_id", F.lit(2)) == 1)).select("term")
    known = vocabulary.document_frequency(bags.where(F.pmod("doc_id", F.lit(2)) == 0))
    return arriving, known


@query
def u1_union_of_states(spark, folder):
    arriving, known = _vocabulary_parts(spark, folder)
    both = known.select("term", "df").unionByName(arriving.withColumn("df", F.lit(1).cast("bigint")))
    return both.groupBy("df").agg(F.count("*").alias("n_rows"))


@query
def u2_known_terms(spark, folder):
    return vocabulary.known_terms(*_vocabulary_parts(spark, folder))


@query
def u3_new_terms(spark, folder):
    return vocabulary.new_terms(*_vocabulary_parts(spark, folder))


# --- machine learning --------------------------------------------------------


@query
def m1_term_frequency(spark, folder):
    return _features(spark, folder).tf.select("doc_id", "term", "n", "tf")


@query
def m2_inverse_frequency(spark, folder):
    return _rounded(_features(spark, folder).idf.select("term", "df", "idf"), "idf")


@query
def m3_inverse_frequency_no_log(spark, folder):
    features = _features(spark, folder)
    plain = weights.inverse_frequency(vocabulary.document_frequency(features.bags), features.n_docs, log=False)
    return _rounded(plain, "idf")


@query
def m4_tfidf(spark, folder):
    return _rounded(_features(spark, folder).tfidf.select("doc_id", "term", "tfidf"), "tfidf")


@query
def m4_top_tfidf_terms(spark, folder):
    return top_terms(_features(spark, folder))


def top_terms(features: Features, k: int = 5) -> DataFrame:
    """The k terms of highest TF·IDF of each document."""
    scored = _rounded(features.tfidf.select("doc_id", "term", "tfidf"), "tfidf")
    order = Window.partitionBy("doc_id").orderBy(F.desc("tfidf"), "term")
    return scored.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


@query
def m5_hash_vectors(spark, folder):
    return _rounded(_features(spark, folder).tfidf_buckets, "w")


@query
def m5_hash_vectors_6000(spark, folder):
    rows = vectors.hash_terms(_features(spark, folder).tfidf, 6000)
    return _rounded(vectors.bucket_sums(rows, "tfidf"), "w")


@query
def m5_hash_vectors_fast(spark, folder):
    """Every bucket of every document, by a cheaper hash than MD5."""
    return _rounded(vectors.bucket_sums(vectors.hash_terms(_features(spark, folder).tfidf, hash_name="xxhash64"), "tfidf"), "w")


@query
def m5_hash_vectors_string(spark, folder):
    """Every bucket of every document, by the multiplicative string hash."""
    return _rounded(vectors.bucket_sums(vectors.hash_terms(_features(spark, folder).tfidf, hash_name="string"), "tfidf"), "w")


def _example_rows(examples: Examples) -> DataFrame:
    """(doc_id, split, positives, bucket, w): every entry of a training set, with the subjects that are labelled 1."""
    pairs = F.zip_with("labels", F.lit(examples.names), lambda y, name: F.when(y == 1.0, name))
    positives = F.array_join(F.array_sort(F.array_compact(pairs)), "|").alias("positives")
    return _rounded(examples.rows.select("doc_id", "split", positives, F.inline("vec")), "w")


@query
def m6_tf_training_set(spark, folder):
    return _example_rows(_examples(spark, folder, "4/3/3", "tf"))


@query
def m7_tfidf_training_set(spark, folder):
    return _example_rows(_examples(spark, folder, "7/2/1", "tfidf"))


@query
def m8_naive_bayes_model(spark, folder):
    model = experiments.naive_bayes_model(_examples(spark, folder, "7/3"))
    return _rounded(model.table().select("subject", "label", "bucket", "theta"), "theta")


@query
def m8_naive_bayes_priors(spark, folder):
    model = experiments.naive_bayes_model(_examples(spark, folder, "7/3"))
    return _rounded(model.priors(), "pi")


@query
def m9_naive_bayes_experiment(spark, folder):
    return _rounded(experiments.naive_bayes_experiment(_examples(spark, folder, "7/3")), *MEASURES)


@query
def m9_naive_bayes_no_log(spark, folder):
    """With the plain quotient for IDF."""
    examples = _examples(spark, folder, "7/3", settings=Settings(log_idf=False))
    return _rounded(experiments.naive_bayes_experiment(examples), *MEASURES)


@query
def m9_naive_bayes_6000(spark, folder):
    examples = _examples(spark, folder, "7/3", settings=Settings(buckets=6000))
    return _rounded(experiments.naive_bayes_experiment(examples), *MEASURES)


def _fit_report(table: DataFrame, slack: float = 1e-9) -> DataFrame:
    """What a fit must show whatever its optimiser: sizes, positives, the majority share, and that training reaches it.

    A tree never falls below the majority; a regularised regression may, by a few documents.
    """
    reached = F.col("train_accuracy") >= F.col("train_majority") - slack
    sizes = [f"{s}_docs" for s in experiments.SPLITS]
    columns = ["setting", *sizes, "train_positives", "train_majority", reached.alias("reaches_majority")]
    return _rounded(table.select("subject", *columns), "train_majority")


def _regression_report(table: DataFrame) -> DataFrame:
    return _fit_report(table, _REGRESSION_SLACK)


def _learned(table: DataFrame, *more: str) -> DataFrame:
    """(subject, setting, accuracy of each part, whether training reaches the majority share)."""
    reached = F.col("train_accuracy") >= F.col("train_majority") - 1e-9
    accuracies = [f"{s}_accuracy" for s in experiments.SPLITS]
    columns = ["setting", *accuracies, *more, reached.alias("reaches_majority")]
    return _rounded(table.select("subject", *columns), *accuracies)


def _size_sweep(run: Callable, spark: SparkSession, folder: str, report: Callable = _fit_report, **options) -> DataFrame:
    """A TF run at each vector size; the size comes before the setting."""
    result = None
    for buckets in TF_SIZES:
        rows = report(run(_tf_examples(spark, folder, buckets), **options))
        rows = rows.withColumn("setting", F.concat_ws("/", F.lit(str(buckets)), "setting"))
        result = rows if result is None else result.unionByName(rows)
    return result


@query
def m10_decision_tree(spark, folder):
    """One tree, for the most frequent subject."""
    return _fit_report(experiments.decision_tree_experiment(_examples(spark, folder).first(1), depths=(3,)))


def _embedding_examples(spark, folder) -> Examples:
    """Ready-made vectors: the labels stand for subjects, folds are dealt by id."""

    def make() -> tuple:
        rows = tables.read_table(spark, folder, "embeddings").select(
            F.col("vec_id").alias("doc_id"), F.array(F.col("label").cast("string")).alias("subjects"), "embedding"
        )
        names = subj.top_names(subj.subject_frequency(rows))
        entries = F.transform("embedding", lambda w, i: F.struct(i.alias("bucket"), w.cast("double").alias("w")))
        run = folds.cyclic_folds(rows).join(rows.select("doc_id", "subjects"), "doc_id")
        vecs = rows.select("doc_id", entries.alias("vec"))
        rows = stage(datasets.training_set(vecs, run, names, "7/2/1"), "embeddings")
        return rows, Examples(rows, names, buckets=64, weighting="ready-made")

    return _once(spark, folder, "embeddings", make)[1]


@query
def m10_embedding_trees(spark, folder):
    return _fit_report(experiments.decision_tree_experiment(_embedding_examples(spark, folder)))


@query
def m10_embedding_tree_nodes(spark, folder):
    """Every node of the trees, with its split."""
    grown = experiments.grown_trees(_embedding_examples(spark, folder))
    return _rounded(grown.table(spark), "threshold", "gain")


@query
def m11_embedding_tree_accuracies(spark, folder):
    return _learned(experiments.decision_tree_experiment(_embedding_examples(spark, folder)))


@query
def m10_tree_nodes(spark, folder):
    return experiments.grown_trees(_examples(spark, folder)).table(spark)


@query
def m11_tree_accuracies(spark, folder):
    return _learned(experiments.decision_tree_experiment(_examples(spark, folder)))


@query
def m11_tree_tf_accuracies(spark, folder):
    return _size_sweep(experiments.decision_tree_experiment, spark, folder, _learned)


@query
def m12_embedding_regressions(spark, folder):
    examples = _embedding_examples(spark, folder)
    return _regression_report(experiments.logistic_regression_experiment(examples, reg_params=(0.01,)))


@query
def m11_decision_tree_sweep(spark, folder):
    return _fit_report(experiments.decision_tree_experiment(_examples(spark, folder)))


@query
def m11_decision_tree_tf_sweep(spark, folder):
    return _size_sweep(experiments.decision_tree_experiment, spark, folder)


@query
def m12_logistic_regression(spark, folder):
    return _regression_report(experiments.logistic_regression_experiment(_examples(spark, folder)))


@query
def m12_regression_accuracies(spark, folder):
    """spark.ml's optimiser at the original setting."""
    return _learned(experiments.logistic_regression_experiment(_examples(spark, folder)), "n_coefficients")


@query
def m13_gradient_sweep(spark, folder):
    """The mini-batch optimiser, all subjects and settings fitted together."""
    run = experiments.gradient_regression_experiment
    return _learned(run(_examples(spark, folder), reg_params=experiments.REG_PARAMS), "n_coefficients")


@query
def m12_gradient_embedding_coefficients(spark, folder):
    """Every coefficient that is not 0, of the regressions over ready-made vectors; bucket 64 is the intercept."""
    models = experiments.gradient_models(_embedding_examples(spark, folder), reg_params=(0.001,))
    rows = [
        (subject, bucket, float(w))
        for (subject, _), weights in zip(models.models, models.weights)
        for bucket, w in enumerate(weights)
        if w
    ]
    return _rounded(spark.createDataFrame(rows, "subject string, bucket int, weight double"), "weight")


@query
def m13_logistic_regression_sweep(spark, folder):
    """From the reference's setting down to where all subjects get coefficients."""
    return _regression_report(
        experiments.logistic_regression_experiment(_examples(spark, folder), reg_params=experiments.REG_PARAMS)
    )


@query
def m13_logistic_regression_tf_sweep(spark, folder):
    run = experiments.logistic_regression_experiment
    return _size_sweep(run, spark, folder, _regression_report, reg_params=(0.3, 0.01))


@query
def m14_predictions(spark, folder):
    return _predictions(spark, folder).select("doc_id", "split", "subject", "label", "prediction")


@query
def m15_alternative_split(spark, folder):
    rows = _manifest(spark, folder).select("doc_id", "fold", folds.split_of(F.col("fold"), "4/3/3").alias("split"))
    return rows


# --- scalar functions --------------------------------------------------------


def _tokens(spark, folder):
    return inputs.corpus(spark, folder).select(F.explode(text.split_words(F.col("text"))).alias("token"))


def _histogram(tokens: DataFrame, value, name: str = "token") -> DataFrame:
    return tokens.select(value.alias(name)).groupBy(name).agg(F.count("*").alias("n"))


@query
def x1_split_words(spark, folder):
    return _histogram(_tokens(spark, folder), F.col("token"))


@query
def x2_lower_case(spark, folder):
    return _histogram(_tokens(spark, folder), text.fold_case(F.col("token")))


@query
def x3_strip_marks(spark, folder):
    """On pieces between blanks, which still carry their punctuation."""
    pieces = inputs.corpus(spark, folder).select(F.explode(F.split("text", " ")).alias("token"))
    return _histogram(pieces, text.strip_marks(F.col("token")))


@query
def x4_ordinals(spark, folder):
    lowered = _tokens(spark, folder).select(text.fold_case(F.col("token")).alias("token"))
    return _histogram(lowered.where(text.is_ordinal(F.col("token"))), F.col("token"))


@query
def x5_length_and_digits(spark, folder):
    token = F.col("token")
    kept = _tokens(spark, folder).where((F.length(token) > 2) & ~text.is_number(token))
    return _histogram(kept, token)


@query
def x6_function_words(spark, folder):
    """The corpus vocabulary without function words, an option that is off by default."""
    df = vocabulary.document_frequency(_features(spark, folder).bags)
    return df.where(~text.is_function_word(F.col("term")))


@query
def x7_line_search(spark, folder):
    lines = corpus.document_lines(inputs.corpus(spark, folder))
    return lines.groupBy("doc_id").agg(
        F.count_if(F.contains("line", F.lit("the"))).alias("with_substring"),
        F.count_if(F.col("line").rlike("^[A-Z][a-z]+ ")).alias("with_pattern"),
    )


@query
def x8_cut_at_marker(spark, folder):
    docs = inputs.marked(spark, folder)
    return docs.select("doc_id", markup.document_id(F.col("text"), ["[Etext"]).alias("etext_id"))


@query
def x9_space_columns(spark, folder):
    lines = inputs.listing_lines(spark, folder)
    cols = lines.select(fields.columns_of(F.col("value")).alias("c"))
    return cols.select(
        F.get("c", F.lit(0)).alias("mode"), F.get("c", F.lit(4)).alias("size_text"), F.get("c", F.lit(8)).alias("file")
    )


@query
def x10_megabytes(spark, folder):
    files = listing.parse_listing(inputs.listing_lines(spark, folder))
    return _rounded(files.groupBy("size_text").agg(F.max("size_mb").alias("size_mb")), "size_mb")


@query
def x11_comma_record(spark, folder):
    return _metadata_records(spark, folder).select(F.col("value").alias("record"))


@query
def x12_bare_field(spark, folder):
    field = F.concat(F.lit("['"), F.col("lang"), F.lit("' \n"))
    docs = inputs.documents(spark, folder)
    return docs.select("doc_id", fields.bare(field).alias("lang"))


@query
def x13_md5_bucket(spark, folder):
    df = vocabulary.document_frequency(_features(spark, folder).bags)
    return df.select("term", hashing.md5_bucket(F.col("term")).alias("bucket"))


@query
def x13_string_bucket(spark, folder):
    df = vocabulary.document_frequency(_features(spark, folder).bags)
    return df.select("term", hashing.string_hash(F.col("term")).alias("hash"), hashing.string_bucket(F.col("term")).alias("bucket"))


@query
def x14_arithmetic(spark, folder):
    docs = inputs.documents(spark, folder)
    ratio = F.col("n_chars") / (F.col("doc_id") + 1)
    return _rounded(docs.select("doc_id", F.ln(ratio).alias("log"), (ratio * 2.5).alias("product")), "log", "product")


@query
def x15_comma_split(spark, folder):
    records = _metadata_records(spark, folder)
    return records.select(F.explode(fields.comma_fields(F.col("value"))).alias("field")).groupBy("field").agg(
        F.count("*").alias("n")
    )


# --- streaming ---------------------------------------------------------------


def _document_files(spark, folder) -> str:
    """The corpus as several files, so that the stream has several batches."""

    path = stage_path(spark, "arrivals")
    files = _BATCHES * _files_per_batch(spark)
    inputs.documents(spark, folder).select("doc_id", "text").repartition(files, "doc_id").write.parquet(path)
    return path


def _files_per_batch(spark) -> int:
    """As many as tasks run at once, so that a batch is counted by all of them."""
    return max(1, spark.sparkContext.defaultParallelism)


@query
def t1_running_frequency(spark, folder):
    """From the log of a stateless stream: one snapshot after the last batch."""
    arriving = running_df.document_stream(spark, _document_files(spark, folder), files_per_batch=_files_per_batch(spark))
    log = stage_path(spark, "frequency-log")
    running_df.start_frequency_log(arriving, log, stage_path(spark, "stream-checkpoint")).awaitTermination()
    return running_df.snapshot(spark, log)[0]


@query
def t1_running_frequency_stateful(spark, folder):
    """From the state store: counts that changed are written per batch; they only grow."""
    arriving = running_df.document_stream(spark, _document_files(spark, folder), files_per_batch=2 * _files_per_batch(spark))
    counts = running_df.running_frequency(arriving, drop_replays=True)
    changes = stage_path(spark, "frequency-changes")

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{changes}/batch={batch_id}")

    stream = (
        counts.writeStream.outputMode("update")
        .foreachBatch(write)
        .option("checkpointLocation", stage_path(spark, "stream-checkpoint"))
        .trigger(availableNow=True)
        .start()
    )
    stream.awaitTermination()
    return spark.read.parquet(changes).groupBy("term").agg(F.max("df").alias("df"))


@query
def j1_arriving_vectors(spark, folder):
    """Vectors of documents that arrive in two halves, the second with a newer IDF table, then the first brought up to date."""
    docs = inputs.documents(spark, folder).select("doc_id", "text")
    source, log, made = (stage_path(spark, n) for n in ("arrivals", "frequency-log", "arriving-vectors"))
    counted, weighted = (stage_path(spark, "stream-checkpoint") for _ in range(2))
    idf = VersionedTable(spark, stage_path(spark, "idf-versions"))
    for half in range(2):
        docs.where(F.pmod(F.xxhash64("doc_id"), F.lit(2)) == half).repartition(2).write.mode("append").parquet(source)
        arriving = lambda: running_df.document_stream(spark, source, files_per_batch=1)
        running_df.start_frequency_log(arriving(), log, counted).awaitTermination()
        arriving_vectors.publish_idf(spark, log, idf)
        arriving_vectors.start_vectors(arriving(), idf, made, weighted).awaitTermination()
    store = arriving_vectors.VectorStore(spark, made)
    store.refresh(idf)
    return _rounded(store.vectors().select("doc_id", F.inline("vec")), "w")
