"""Sinks, the landing stream and the provider's cache."""

from pyspark.sql import functions as F

from tabulith.functions.provider import ask
from tabulith.sources import sinks
from tabulith.streaming.landing import take_in, verdict


def test_sinks_round_trip(spark, tmp_path):
    rows = spark.createDataFrame([(1, "a", None), (2, "b", 2.5)], "stream int, text string, struck double")
    sinks.write_parquet(rows, str(tmp_path / "p"), "stream")
    sinks.write_parquet(rows.filter("stream = 2").withColumn("text", F.lit("c")), str(tmp_path / "p"), "stream")
    assert {(r.stream, r.text) for r in spark.read.parquet(str(tmp_path / "p")).collect()} == {(1, "a"), (2, "c")}
    sinks.write_json_lines(rows, str(tmp_path / "j"))
    assert sorted(r.value for r in spark.read.text(str(tmp_path / "j")).collect()) == ['{"stream":1,"struck":null,"text":"a"}', '{"stream":2,"struck":2.5,"text":"b"}']
    assert sinks.json_lines(rows, keep_nulls=False).filter("value = '{\"stream\":1,\"text\":\"a\"}'").count() == 1
    back = sinks.read_json_lines(spark, str(tmp_path / "j"), "stream int, text string, struck double")
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, rows.collect()))


def test_stale_files(spark):
    names = lambda *x: spark.createDataFrame([(n,) for n in x], "file string")
    assert [r.file for r in sinks.stale(names("a", "b", "b"), names("a")).collect()] == ["b"]


def test_uploads_are_taken_in_once(spark, tmp_path):
    land = tmp_path / "land"
    land.mkdir()
    for name, body in (("a.pdf", b"%PDF-1.7 x"), ("b.txt", b"%PDF-"), ("c.PDF", b"no"), ("d.pdf", b"")):
        (land / name).write_bytes(body)
    for _ in range(2):
        take_in(spark, str(land), str(tmp_path / "out"), str(tmp_path / "ck")).awaitTermination(60)
    got = {r.path.rsplit("/", 1)[1]: r.verdict for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    # Spark's file reader passes over files without a byte
    assert got == {"a.pdf": "accepted", "b.txt": "not_a_pdf_name", "c.PDF": "no_pdf_magic"}
    assert spark.read.parquet(str(tmp_path / "out")).count() == 3
    batch = spark.createDataFrame([("d.pdf", 0, bytearray(b""))], "path string, length long, content binary")
    assert batch.select(verdict(F.col("path"), F.col("length"), F.col("content"))).first()[0] == "empty"


def test_only_misses_are_asked(spark):
    prompts = spark.createDataFrame([(1, "x | component row a"), (2, "x | component row a"), (3, "note")], "id int, prompt string")
    empty = spark.createDataFrame([], "fingerprint string, answer string")
    answered, fresh = ask(prompts, empty)
    assert fresh.count() == 2 and {r.id: r.answer for r in answered.collect()} == {1: "x | component row a", 2: "x | component row a", 3: ""}

    def refuse(prompt):
        raise AssertionError("cached requests must not be asked")

    again, new = ask(prompts, spark.createDataFrame(fresh.collect(), fresh.schema), refuse)
    assert new.count() == 0 and again.filter("answer IS NULL").count() == 0
