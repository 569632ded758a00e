"""Work that is dealt over tasks, done once, and kept small within a task, however large the tables are."""

import pyarrow as pa
from pyspark.sql import functions as F

from palisade.functions import text
from palisade.operators import html
from palisade.plans import catalog
from palisade.sources import corpus_source


def test_rows_of_one_file_are_dealt_over_tasks(spark):
    rows = spark.range(0, 25_000, numPartitions=1)
    n = catalog.spread(rows).rdd.getNumPartitions()
    assert n >= max(3, spark.sparkContext.defaultParallelism)


def test_batches_are_folded_in_slices():
    sizes = []
    run = lambda some: sizes.append(len(some)) or text._folded(some)
    got = text.in_slices(pa.array(["é", None, "a"] * 200), run, pa.string())
    assert got.to_pylist() == ["e", None, "a"] * 200 and max(sizes) <= 128
    assert len(text.in_slices(pa.array([], pa.string()), run, pa.string())) == 0


def test_pages_and_texts_of_a_long_batch(spark):
    rows = spark.range(300).select("id", F.when(F.col("id") % 7 > 0, F.concat(F.lit("<title>é"), "id", F.lit("</title>"))).alias("h"))
    got = rows.select("id", html.page_parts("h").alias("p"), text.fold("h").alias("t")).collect()
    assert all(r.p.title == (f"é{r.id}" if r.id % 7 else None) and r.t == (f"<title>e{r.id}</title>" if r.id % 7 else None) for r in got)


def test_records_of_a_corpus_are_made_once_and_dealt(spark, tmp_path):
    from palisade.operators import records

    n, seen = 9000, spark.sparkContext.accumulator(0)

    @F.udf("string")
    def counted(i):
        seen.add(1)
        return f'{{"title": "t{i}"}}'

    made = records.normalize(spark.range(n).select("id", counted("id").alias("document")))
    url = F.concat(F.lit("https://e.example.test/"), F.col("id").cast("string"))
    day = F.lit("2024-02-01").cast("date")
    folder = f"file://{tmp_path}/corpus"
    corpus_source.write_corpus(records.enrich(made.withColumn("url", url), "url", day, day.cast("timestamp")), folder)
    assert seen.value == n
    assert len(list((tmp_path / "corpus" / "_parts").rglob("*.json"))) > 1
    assert corpus_source.read_corpus(spark, folder).count() == n
