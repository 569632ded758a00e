"""Images to texts: fetched and decoded once each, filtered, prepared and recognised; what reads the web and the pixels is injected."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from palisade.functions.text import decodable, image_reason, readable
from palisade.scratch import new_folder

#: Contrast, and the weights of the sharpening filter (fixed values).
CONTRAST = 1.5
SHARPEN = np.array([[-2, -2, -2], [-2, 32, -2], [-2, -2, -2]]) / 16
#: Shares of red, green and blue in grey (fixed values).
GREY = np.array([0.299, 0.587, 0.114])

Fetch = Callable[[str], tuple[int, str, bytes]]
Decode = Callable[[bytes], np.ndarray]
Recognise = Callable[[np.ndarray], str]

READ = "image_url string, status int, content_type string, width int, height int, content binary"


def prepare(pixels: np.ndarray) -> np.ndarray:
    """Grey, with a little more contrast around the mean, lightly sharpened: what text in screenshots is read best from."""
    x = np.asarray(pixels, float)
    if x.ndim == 3:
        x = np.round(x[..., :3] @ GREY)
    if not x.size:
        return x.astype(np.uint8)
    mean = np.floor(x.mean() + 0.5)
    x = np.clip(mean + CONTRAST * (x - mean), 0, 255).astype(np.uint8).astype(float)
    out = x.copy()
    if min(x.shape) > 2:  # the outermost pixels stay as they are
        inner = sum(SHARPEN[i, j] * x[i : i + x.shape[0] - 2, j : j + x.shape[1] - 2] for i in range(3) for j in range(3))
        out[1:-1, 1:-1] = np.clip(np.round(inner), 0, 255)
    return out.astype(np.uint8)


def decode_pillow(content: bytes) -> np.ndarray:
    """Pixels by Pillow, where that is installed."""
    from io import BytesIO

    from PIL import Image

    return np.asarray(Image.open(BytesIO(content)).convert("RGB"))


def fetched_images(images: DataFrame, fetch: Fetch, decode: Decode = decode_pillow) -> DataFrame:
    """image_url, status, content_type, width, height, content of each distinct image_url; width is null where it couldn't be decoded, status 0 where it couldn't be fetched."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for url in batch["image_url"]:
                try:
                    status, kind, content = fetch(url)
                except Exception as e:  # every kind of failure is a row
                    out.append((url, 0, f"error: {type(e).__name__}", None, None, None))
                    continue
                try:
                    height, width = decode(content).shape[:2]
                    out.append((url, status, kind, width, height, content))
                except Exception:  # what can't be decoded has no size
                    out.append((url, status, kind, None, None, None))
            frame = pd.DataFrame(out, columns=["image_url", "status", "content_type", "width", "height", "content"])
            yield frame.astype({"width": "Int32", "height": "Int32"})

    return images.select("image_url").distinct().mapInPandas(run, READ)


def judged_images(fetched: DataFrame) -> DataFrame:
    """fetched with `skipped`: why an image isn't worth reading, null if it is."""
    reason = (
        F.when((F.col("status") == 0) | (F.col("status") >= 400), "failed")
        .when(~decodable(F.col("content_type")), "content type")
        .when(F.col("width").isNull(), "undecodable")
        .otherwise(image_reason(F.col("width"), F.col("height")))
    )
    return fetched.withColumn("skipped", reason)


def read_images(images: DataFrame, fetch: Fetch, recognise: Recognise, decode: Decode = decode_pillow, prepared: Callable[[np.ndarray], np.ndarray] = prepare) -> DataFrame:
    """(image_url, skipped, text), one row a distinct image: its recognised text, empty if it isn't worth keeping.

    The calls are not repeatable: write the result, and give later runs only images that it doesn't have.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            texts = []
            for content, skipped in zip(batch["content"], batch["skipped"], strict=True):
                try:
                    texts.append("" if skipped is not None else recognise(prepared(decode(content))) or "")
                except Exception:  # an image that the reader gives up on has no text
                    texts.append("")
            yield batch[["image_url", "skipped"]].assign(text=texts)

    read = judged_images(fetched_images(images, fetch, decode)).mapInPandas(run, "image_url string, skipped string, text string")
    return read.withColumn("text", F.when(readable(F.col("text")), F.trim("text")).otherwise(""))


def image_summary(read: DataFrame) -> DataFrame:
    """One row: distinct images, and those that gave a text."""
    return read.agg(F.countDistinct("image_url").alias("n_images"), F.count_distinct(F.when(F.col("text") != "", F.col("image_url"))).alias("n_with_text"))


#: Partitions of a memo by the image URL's hash.
MEMO_BUCKETS = 64
MEMO = "image_url string, digest string, skipped string, text string"


def _memo(spark: SparkSession, folder: str) -> DataFrame:
    """(image_url, digest, skipped, text, bucket) of what earlier runs read; none if nothing was."""
    try:
        return spark.read.schema(f"{MEMO}, bucket int").parquet(folder)
    except AnalysisException:
        return spark.createDataFrame([], f"{MEMO}, bucket int")


def read_remembered(images: DataFrame, memo: str, fetch: Fetch, recognise: Recognise, decode: Decode = decode_pillow, prepared: Callable[[np.ndarray], np.ndarray] = prepare) -> DataFrame:
    """read_images over runs: (image_url, skipped, text) of each distinct image, of which only what the memo lacks is fetched.

    Of images with the same bytes one is recognised, in this run or an earlier one, whatever their URLs. What was read is
    added to the memo, a shared folder, before this returns; failed fetches aren't, so they are tried again. Two runs at
    once may read an image twice; the memo then has two rows of it, of which one counts.
    """
    spark = images.sparkSession
    wanted = images.where("image_url is not null").select("image_url").distinct().withColumn("bucket", F.pmod(F.xxhash64("image_url"), F.lit(MEMO_BUCKETS)).cast("int"))
    known = _memo(spark, memo)
    new = wanted.join(known.select("image_url", "bucket"), ["image_url", "bucket"], "left_anti")
    at = new_folder(spark, "images")  # fetched once, whatever is asked of it below
    judged_images(fetched_images(new, fetch, decode)).withColumn("digest", F.sha2("content", 256)).write.parquet(f"{at}/fetched")
    fetched = spark.read.parquet(f"{at}/fetched")
    worth = fetched.where("skipped is null").groupBy("digest").agg(F.min("image_url").alias("image_url"))
    worth = worth.join(known.where("digest is not null and skipped is null").select("digest"), "digest", "left_anti")
    contents = worth.join(fetched.select("image_url", "content"), "image_url")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            texts = []
            for content in batch["content"]:
                try:
                    texts.append(recognise(prepared(decode(content))) or "")
                except Exception:  # an image that the reader gives up on has no text
                    texts.append("")
            yield pd.DataFrame({"digest": batch["digest"], "text": texts})

    read = contents.select("digest", "content").mapInPandas(run, "digest string, text string")
    read = read.withColumn("text", F.when(readable(F.col("text")), F.trim("text")).otherwise(""))
    read.write.parquet(f"{at}/read")
    texts = spark.read.schema("digest string, text string").parquet(f"{at}/read")
    before = known.where("digest is not null and skipped is null").groupBy("digest").agg(F.min("text").alias("text"))
    texts = texts.union(before.join(fetched.select("digest").distinct(), "digest", "left_semi"))
    rows = fetched.join(texts, "digest", "left").select("image_url", "digest", "skipped", F.when(F.col("skipped").isNull(), F.coalesce("text", F.lit(""))).otherwise("").alias("text"))
    rows.write.parquet(f"{at}/rows")
    rows = spark.read.schema(MEMO).parquet(f"{at}/rows")
    bucket = F.pmod(F.xxhash64("image_url"), F.lit(MEMO_BUCKETS)).cast("int")
    rows.where("skipped is null or skipped <> 'failed'").withColumn("bucket", bucket).repartition("bucket").write.mode("append").partitionBy("bucket").parquet(memo)
    known = spark.read.schema(f"{MEMO}, bucket int").parquet(memo)  # listed anew: the files that are there now
    old = known.join(wanted, ["image_url", "bucket"], "left_semi").join(rows.select("image_url"), "image_url", "left_anti").select("image_url", "skipped", "text")
    return old.dropDuplicates(["image_url"]).union(rows.select("image_url", "skipped", "text"))
