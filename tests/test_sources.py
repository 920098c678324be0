"""Text files, manifests, metadata and listings."""

from __future__ import annotations

import subprocess

import pytest
from pyspark.sql import functions as F

from tomeworks.functions.fields import bare, ebook_id, megabytes
from tomeworks.operators.subjects import has_subject, one_vs_rest, subject_frequency, top
from tomeworks.plans import inputs
from tomeworks.plans.subject_metadata import subject_metadata
from tomeworks.sources import corpus, listing, manifest, metadata, sinks, tables

# Two lines of a run manifest in the format to be read, one with a final comma, one made up.
MANIFEST = [
    "19.tf,0,ID=19,Indians of North America -- Poetry,Iroquois Indians -- Kings and rulers -- Poetry,PS,Hiawatha, active 15th century -- Poetry",
    "126.tf,1,ID=126,PR,Science fiction,Challenger, Professor (Fictitious character) -- Fiction",
    "12200.tf,2,ID=12200,Elocution,Oratory,PN,Delsarte system,",
    "1220.tf,3,ID=1220,PR,,PS",
]


def test_text_documents(spark, tmp_path):
    (tmp_path / "a" / "b").mkdir(parents=True)
    (tmp_path / "a" / "19.txt").write_bytes(b"one\r\ntwo\n")
    (tmp_path / "a" / "b" / "20.txt").write_text("three")
    (tmp_path / "a" / "b" / "21.zip").write_text("no")
    (tmp_path / "a" / "truck20.txt").write_text("another book")
    found = corpus.text_documents(spark, str(tmp_path))
    assert found.columns == ["path", "file", "text"]
    rows = found.orderBy("path").collect()
    assert [(r["file"], r["text"]) for r in rows] == [
        ("19.txt", "one\ntwo\n"),
        ("20.txt", "three"),
        ("truck20.txt", "another book"),
    ]


def test_the_partition_hint_is_a_minimum(spark, tmp_path):
    for i in range(12):
        (tmp_path / f"{i}.txt").write_text("\n".join(f"line {j}" for j in range(200)))
    lines = corpus.text_lines(spark, str(tmp_path), at_least=10)
    assert lines.rdd.getNumPartitions() >= 10
    assert lines.count() == 2400
    assert "Exchange" not in plan_of(lines)
    one = corpus.text_lines(spark, str(tmp_path / "1.txt"), at_least=10)
    assert one.rdd.getNumPartitions() >= 10 and one.distinct().count() == 200
    # more splits than asked for stay as they are
    spark.conf.set("spark.sql.files.maxPartitionBytes", 500)
    try:
        assert spark.read.text(str(tmp_path)).rdd.getNumPartitions() > 10
        assert corpus.text_lines(spark, str(tmp_path), at_least=2).rdd.getNumPartitions() >= 2
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_the_corpus_is_never_exchanged(spark, folder):
    assert "Exchange" not in plan_of(inputs.corpus(spark, folder))
    assert "Exchange" not in plan_of(inputs.marked(spark, folder))


def test_metadata_files_and_outcomes(spark, tmp_path):
    for i, xml in enumerate([XML, XML.replace("ebooks/77", "ebooks/none"), XML[:-30]]):
        (tmp_path / str(i)).mkdir()
        (tmp_path / str(i) / f"pg{i}.rdf").write_text(xml)
    (tmp_path / "0" / "notes.txt").write_text("no record")
    job = subject_metadata(metadata.metadata_files(spark, str(tmp_path)))
    assert tuple(job.outcome.first()) == (3, 1, 1, 1)
    assert [r["doc_id"] for r in job.metadata.collect()] == [77]


def test_files_of_many_records(spark, tmp_path):
    """The same outcomes as from a file for each record, from one file that several tasks read."""
    body = XML[XML.index("<p:ebook") : XML.index("</rdf:RDF>")]
    head = XML[: XML.index("<p:ebook")]
    numbered = [body.replace("ebooks/77", f"ebooks/{i}" if i % 50 else "ebooks/none") for i in range(10_000)]
    numbered = [b if i % 70 != 3 else b[: b.rindex("</p:ebook>")] for i, b in enumerate(numbered)]
    unclosed = sum(i % 70 == 3 for i in range(10_000))
    nameless = sum(i % 50 == 0 and i % 70 != 3 for i in range(10_000))
    (tmp_path / "many" / "deep").mkdir(parents=True)
    (tmp_path / "many" / "deep" / "all.rdf").write_text(head + "\n".join(numbered) + "\n</rdf:RDF>\n")
    (tmp_path / "many" / "none.rdf").write_text("<rdf:RDF><p:ebooks>no record</p:ebooks></rdf:RDF>")
    (tmp_path / "many" / "empty.rdf").write_text("")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "200000")
    try:
        records = metadata.metadata_records(spark, str(tmp_path / "many"), record="p:ebook")
        assert records.rdd.getNumPartitions() > 5
        job = subject_metadata(records)
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert tuple(job.outcome.first()) == (10_000, 10_000 - unclosed - nameless, unclosed, nameless)
    expected = metadata.usable(metadata.parse_metadata(spark.createDataFrame([(XML,)], "xml string"))).first()
    assert {tuple(r.subjects) for r in job.metadata.collect()} == {tuple(expected.subjects)}
    assert {r.doc_id for r in job.metadata.collect()} == {i for i in range(10_000) if i % 50 and i % 70 != 3}


def test_manifest_lines_keep_any_subject(spark, tmp_path):
    subjects = ["one, two", "line\nbreak", "100%", "%2C", "a\rb", "plain"]
    typed = spark.createDataFrame([(7, 3, subjects)], "doc_id bigint, fold int, subjects array<string>")
    sinks.save_manifest_lines(typed, str(tmp_path / "lines"))
    again = manifest.parse_manifest(spark.read.text(str(tmp_path / "lines"))).collect()
    assert [(r["doc_id"], r["fold"], r["subjects"]) for r in again] == [(7, 3, subjects)]


def test_manifest(spark, tmp_path):
    lines = spark.createDataFrame([(m,) for m in MANIFEST], "value string")
    parsed = manifest.parse_manifest(lines)
    rows = {r["doc_id"]: r for r in parsed.collect()}
    assert rows[126]["fold"] == 1 and rows[126]["file"] == "126.tf"
    assert rows[12200]["subjects"] == ["Elocution", "Oratory", "PN", "Delsarte system"]
    assert rows[1220]["subjects"] == ["PR", "PS"]
    # counts split on commas, as in the line form
    counts = {r["subject"]: r["n"] for r in subject_frequency(parsed).collect()}
    assert counts["PR"] == 2 and counts["PS"] == 2 and counts["Hiawatha"] == 1
    assert [r["subject"] for r in top(subject_frequency(parsed), 2).collect()] == ["PR", "PS"]
    written = str(tmp_path / "lines")
    sinks.save_manifest_lines(parsed, written, trailing_comma=True)
    assert "126.tf,1,ID=126,PR,Science fiction,Challenger, Professor (Fictitious character) -- Fiction," in {
        r["value"] for r in spark.read.text(written).collect()
    }
    again = manifest.parse_manifest(spark.read.text(written))
    assert again.orderBy("doc_id").collect() == parsed.orderBy("doc_id").collect()


def test_labels_are_exact(spark):
    docs = spark.createDataFrame(
        [(1220, ["PR"]), (12201, ["PR", "Humorous stories, English"]), (3, ["English"])],
        "doc_id bigint, subjects array<string>",
    )
    got = {r["doc_id"]: r["y"] for r in docs.select("doc_id", has_subject("English").alias("y")).collect()}
    assert got == {1220: 0.0, 12201: 0.0, 3: 1.0}
    rows = one_vs_rest(docs, ["PR", "Humorous stories, English"]).collect()
    assert sum(r["label"] for r in rows) == 3.0 and len(rows) == 6


XML = """<rdf:RDF xmlns:rdf="http://www.w3.org/1999/02/22-rdf-syntax-ns#" xmlns:p="http://x/">
<p:ebook rdf:about="ebooks/77"><p:title>T</p:title>
<p:subject><rdf:Description rdf:nodeID="N1"><m:memberOf xmlns:m="u:m"/><rdf:value>Humorous stories, English</rdf:value></rdf:Description></p:subject>
<p:subject><rdf:Description><rdf:value>PR</rdf:value></rdf:Description></p:subject>
</p:ebook></rdf:RDF>"""


def test_metadata(spark):
    no_subject = XML[: XML.index("<p:subject>")] + "</p:ebook></rdf:RDF>"
    df = spark.createDataFrame([(XML,), (XML[:-30],), (no_subject,), ("junk",)], "xml string")
    parsed = metadata.parse_metadata(df)
    good = metadata.usable(parsed).collect()
    assert sorted(r["subjects"] for r in good) == [[], ["Humorous stories, English", "PR"]]
    assert {r["doc_id"] for r in good} == {77}
    assert parsed.where("is_bad or doc_id is null").count() == 2


def test_listing(spark):
    lines = [
        "-rw-r--r-- 1 u g 3.0M Jan  1 2010 10136.txt",
        "-rw-r--r--   1 u   g  2.5M Jan 1 2010 1.txt",
        "-rw-r--r-- 1 u g 3G Jan 1 2010 2.txt",
        "-rw-r--r-- 1 u g 900K Jan 1 2010 3.txt",
        "-rw-r--r-- 1 u g 9000000 Jan 1 2010 4.txt",
        "-rw-r--r-- 1 u g 5.0M Jan 1 2010 5.zip",
        "total 12",
    ]
    df = spark.createDataFrame([(x,) for x in lines], "value string")
    big = listing.big_files(listing.parse_listing(df))
    assert {r["file"] for r in big.collect()} == {"10136.txt", "2.txt", "4.txt"}
    compat = listing.big_files(listing.parse_listing(df, reference_compat=True))
    assert [tuple(r) for r in listing.exclusion_records(compat).collect()] == [("TOOBIG", "10136.txt", "3.0M")]


@pytest.mark.parametrize(("size", "mb"), [("3.0M", 3.0), ("512K", 0.5), ("2G", 2048.0), ("1048576", 1.0)])
def test_megabytes(spark, size, mb):
    df = spark.createDataFrame([(size,)], "s string")
    assert df.select(megabytes(F.col("s")).alias("mb")).first()["mb"] == mb


def test_fields(spark):
    df = spark.createDataFrame([("['12.tf' \n", "ebooks/12")], "f string, a string")
    row = df.select(bare(F.col("f")).alias("f"), ebook_id(F.col("a")).alias("a")).first()
    assert tuple(row) == ("12.tf", "12")


def test_fold_folders_are_pruned(spark, tmp_path):
    df = spark.range(40).select(F.col("id").alias("doc_id"), (F.col("id") % 10).cast("int").alias("fold"))
    path = str(tmp_path / "folds")
    sinks.save_by_fold(df, path)
    read = tables.read_features(spark, path, folds=[7, 8])
    assert read.count() == 8
    plan = read._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [fold" in plan


def test_sizes_of_the_file_system_give_the_exclusion_list_of_a_listing(spark, tmp_path):
    sizes = [0, 1, 1023, 1024, 1025, 10_239, 10_240, 10_241, 2_621_440, 2_621_441, 2_600_000, 10_485_760, 10_485_761, 99_999_999]
    (tmp_path / "sub").mkdir()
    for i, size in enumerate(sizes):
        with open(tmp_path / ("sub" if i % 2 else ".") / f"{i}.txt", "wb") as file:
            file.truncate(size)
    (tmp_path / "other.zip").write_bytes(b"x")
    lines = subprocess.run(["ls", "-lhR", str(tmp_path)], capture_output=True, text=True, check=True).stdout.splitlines()
    listed = listing.parse_listing(spark.createDataFrame([(line,) for line in lines], "value string"))
    found = listing.file_sizes(spark, str(tmp_path))
    assert "content" not in found._jdf.queryExecution().executedPlan().toString()
    text = lambda df: {(r.file, r.size_text) for r in df.collect()}
    assert text(found) == text(listed) - {("0.txt", "0")} and found.count() == len(sizes) - 1  # the empty one
    records = lambda df: sorted(map(tuple, listing.exclusion_records(listing.big_files(df)).collect()))
    assert records(found) == records(listed) and len(records(found)) == 4
