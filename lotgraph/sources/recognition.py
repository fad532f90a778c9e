"""Recognition of page images behind an interface, with variants, scoring and a retry at a higher resolution."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import Protocol

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.documents import cover_score, fragmented, native_is_enough
from ..functions.text import company_names
from ..operators.graph import Scratch, there
from .files import add_to_cache, cached


class Backend(Protocol):
    """One model for each worker process."""

    def prepare(self) -> None: ...

    def recognize(self, image: np.ndarray) -> list[tuple[str, float, list[list[float]]]]: ...


def without_red_seal(image: np.ndarray) -> np.ndarray:
    """Pixels that are clearly red become white."""
    rgb = image[..., :3].astype(np.int16)
    red = (rgb[..., 0] > 120) & (rgb[..., 0] - rgb[..., 1] > 40) & (rgb[..., 0] - rgb[..., 2] > 40)
    out = image.copy()
    out[red] = 255
    return out


def red_channel(image: np.ndarray) -> np.ndarray:
    """Grey by the red channel, in which red print is bright."""
    return np.repeat(image[..., :1], 3, axis=-1)


def cropped(image: np.ndarray, top: float, bottom: float) -> np.ndarray:
    height = image.shape[0]
    return image[int(height * top) : max(int(height * bottom), int(height * top) + 1)]


def variants(image: np.ndarray, with_top: bool = True, retry: bool = False) -> list[tuple[str, np.ndarray]]:
    """The image, the image without its seal, and the upper half where titles stand; at a retry only the cleaned ones."""
    out = [] if retry else [("original", image)]
    out.append(("no_seal", without_red_seal(image)))
    if with_top:
        out.append(("top", cropped(without_red_seal(image), 0.0, 0.55)))
    if retry:
        out.append(("red", red_channel(image)))
    return out


_models: dict[str, Backend] = {}


def recognize(pages: DataFrame, factory: Callable[[], Backend], render: Callable[[str, int, int], np.ndarray], name: str = "default", retry: bool = False) -> DataFrame:
    """(doc_path, page_number, dpi, variant, text, mean_score) for each variant of the pages' images."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        if name not in _models:
            _models[name] = factory()
            _models[name].prepare()
        for frame in frames:
            rows = []
            for path, number, dpi in zip(frame.doc_path, frame.page_number, frame.dpi, strict=True):
                for variant, image in variants(render(path, number, dpi), retry=retry):
                    found = _models[name].recognize(image)
                    scores = [s for t, s, _ in found if t.strip()]
                    rows.append((path, number, dpi, variant, "\n".join(t for t, _, _ in found), float(np.mean(scores)) if scores else 0.0))
            yield pd.DataFrame(rows, columns=["doc_path", "page_number", "dpi", "variant", "text", "mean_score"])

    return pages.select("doc_path", "page_number", "dpi").mapInPandas(run, "doc_path string, page_number int, dpi int, variant string, text string, mean_score double")


def best_variant(read: DataFrame) -> DataFrame:
    """For each page the variant with the best score, and whether it must be read again."""
    company = F.coalesce(F.get(company_names(F.col("text")), F.lit(0)), F.lit(""))
    scored = read.withColumns({"company": company, "score": cover_score(F.col("text"), F.col("mean_score"), company)})
    best = scored.groupBy("doc_path", "page_number").agg(F.max_by(F.struct("variant", "text", "mean_score", "company", "dpi", "score"), F.struct("score", "variant")).alias("b")).select("doc_path", "page_number", "b.*")
    return best.withColumn("again", fragmented(F.col("text"), F.col("mean_score"), F.col("company")))


def retry_dpi(dpi):
    return F.greatest(dpi + 50, F.ceil(dpi * 1.25)).cast("int")


def company_vote(candidates: DataFrame) -> DataFrame:
    """Of the names read on variants the one with the best score, then the most votes, then the highest confidence."""
    per = candidates.groupBy("doc_path", "name").agg(F.max("score").alias("score"), F.count("*").alias("votes"), F.max("confidence").alias("confidence"))
    return per.groupBy("doc_path").agg(F.max_by("name", F.struct("score", "votes", "confidence", "name")).alias("name"))


def needs_recognition(pages: DataFrame, forced: bool = False) -> tuple[DataFrame, DataFrame]:
    """(native, images): pages whose text layer is enough never reach the recognition branch."""
    enough = F.lit(not forced) & native_is_enough(F.col("text"))
    return pages.where(enough), pages.where(~enough)


#: What the cache keeps of a page.
READ = ["sha256", "page_number", "dpi", "profile", "text", "mean_score", "variant", "company"]
READ_SCHEMA = "sha256 string, page_number int, dpi int, profile string, text string, mean_score double, variant string, company string"


def read_with_fallback(pages: DataFrame, cache_path: str, factory: Callable[[], Backend], render: Callable[[str, int, int], np.ndarray], profile: str = "default", forced: bool = False) -> DataFrame:
    """Pages as they are read in the end: (doc_path, page_number, sha256, text, method, dpi, mean_score, variant, source).

    pages: doc_path, sha256, page_number, dpi, text (of the text layer, null without). A text layer that is enough is taken as it is (source native). Of the others those that the
    cache has for the file, page, resolution and profile come from it (cache). The rest alone are recognised in all variants; a page whose best variant is fragmented is
    recognised once more at a higher resolution, and the better of both readings counts (read). Recognition is evaluated once: its results are written, then appended to the cache and
    returned. Copies of a file are recognised once. Null hashes are never cached.
    """
    spark = pages.sparkSession
    scratch = Scratch(spark)
    native, images = needs_recognition(pages, forced)
    images = images.withColumn("profile", F.lit(profile))
    cache = spark.read.schema(READ_SCHEMA).parquet(cache_path) if there(spark, cache_path) else spark.createDataFrame([], READ_SCHEMA)
    hits, misses = cached(images.select("doc_path", "sha256", "page_number", "dpi", "profile"), cache)
    key = F.coalesce("sha256", "doc_path")
    once = misses.groupBy(key.alias("_file"), "page_number", "dpi").agg(F.min("doc_path").alias("doc_path"), F.first("sha256").alias("sha256"))
    once = scratch.keep(once, "misses")
    first = scratch.keep(best_variant(recognize(once, factory, render, profile)), "first")
    retried = first.where("again").select("doc_path", "page_number", retry_dpi(F.col("dpi")).alias("dpi"))
    second = scratch.keep(best_variant(recognize(retried, factory, render, profile, retry=True)), "second")
    both = first.unionByName(second).groupBy("doc_path", "page_number").agg(F.max_by(F.struct("text", "mean_score", "variant", "company"), F.struct("score", -F.col("dpi"))).alias("b"))
    got = once.join(both, ["doc_path", "page_number"]).select("_file", "sha256", "page_number", "dpi", F.lit(profile).alias("profile"), "b.text", "b.mean_score", "b.variant", "b.company")
    got = scratch.keep(got, "read")
    add_to_cache(got.where("sha256 is not null").select(*READ), cache_path)
    shown = lambda df, method, source: df.select("doc_path", "page_number", "sha256", "text", F.lit(method).alias("method"), "dpi", "mean_score", "variant", F.lit(source).alias("source"))
    fresh = misses.select("doc_path", "sha256", "page_number", "dpi", key.alias("_file")).join(got.drop("sha256", "profile"), ["_file", "page_number", "dpi"])
    plain = native.withColumns({"mean_score": F.lit(1.0), "variant": F.lit("native")})
    return shown(plain, "text", "native").unionByName(shown(hits, "ocr", "cache")).unionByName(shown(fresh, "ocr", "read"))
