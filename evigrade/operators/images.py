"""Images: queue, duplicates, visual decision, diagnostics."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType
from pyspark.sql.window import Window

from evigrade.functions import vocab
from evigrade.functions.text import any_term, col, filled, vision_verdict

NEAR = 6


def is_skipped_image(url: Column | str) -> Column:
    """Inline data and page furniture."""
    return filled(url).startswith("data:") | filled(url).rlike(vocab.SKIPPED_IMAGE)


def image_queue(candidates: DataFrame, most: int = 30) -> DataFrame:
    """The first distinct usable URLs of each request, in document order, with their first alt text.

    candidates: scrape_id, ordinal, url, alt.  First-seen is a partial aggregate.
    """
    usable = candidates.where(~is_skipped_image("url") & (filled("url") != ""))
    first = usable.groupBy("scrape_id", "url").agg(F.min_by(F.struct("ordinal", "alt"), "ordinal").alias("f"))
    place = F.row_number().over(Window.partitionBy("scrape_id").orderBy("f.ordinal", "url"))
    queue = first.withColumn("position", place).where(F.col("position") <= most)
    return queue.select("scrape_id", "position", "url", filled("f.alt").alias("alt"), F.col("f.ordinal").alias("ordinal"))


def exact_duplicates(images: DataFrame) -> DataFrame:
    """One image for each content of a request, the first; alt texts of the others are appended unless contained.

    images: scrape_id, ordinal, sha8, alt.  Equal alt texts are one before they are gathered.
    """
    alts = images.groupBy("scrape_id", "sha8", filled("alt").alias("alt")).agg(F.min("ordinal").alias("ordinal"), F.count("*").alias("n"))
    all_alts = F.transform(F.array_sort(F.collect_list(F.struct("ordinal", "alt"))), lambda x: x["alt"])

    def add(seen: Column, alt: Column) -> Column:
        more = F.when(seen == "", alt).otherwise(F.concat(seen, F.lit(" | "), alt))
        return F.when((alt == "") | F.contains(seen, alt), seen).otherwise(more)

    found = alts.groupBy("scrape_id", "sha8").agg(
        F.min("ordinal").alias("ordinal"), F.sum("n").alias("copies"), all_alts.alias("_alts")
    )
    return found.withColumn("alt", F.aggregate("_alts", F.lit(""), add)).drop("_alts")


def content_hash(content: Column | str) -> Column:
    return F.left(F.sha1(col(content)), F.lit(8))


def cosine_basis(n: int = 32) -> np.ndarray:
    """The transform's matrix as results need it: rows are samples, columns frequencies."""
    at, k = np.arange(n)[:, None], np.arange(n)[None, :]
    return np.cos(np.pi * (2 * at + 1) * k / (2 * n))


def perceptual_bits(grey: np.ndarray) -> int:
    """64 bits of a 32x32 grey image: low frequencies above their median, the first bit 0."""
    basis = cosine_basis(grey.shape[0])
    low = (basis @ grey.astype(float) @ basis.T)[:8, :8].ravel()
    bits = low > np.median(low[1:])
    bits[0] = False
    return int("".join("1" if b else "0" for b in bits), 2)


@F.pandas_udf(StringType())
def perceptual_hash(pixels: pd.Series) -> pd.Series:
    """16 hex digits for 1024 grey values, row by row."""
    return pixels.map(lambda p: None if p is None else f"{perceptual_bits(np.asarray(p).reshape(32, 32)):016x}")


def _joined(own: str, more: str) -> str:
    """An alt text and another one, unless that is part of it."""
    if not more or more in own:
        return own
    return f"{own} | {more}" if own else more


def near_duplicates(images: DataFrame, near: int = NEAR) -> DataFrame:
    """Greedy clustering of each request's images by perceptual hash, in scan order.

    images: scrape_id, ordinal, phash (64-bit long, null: unknown), area, bytes.  An
    image joins the first kept image within `near` bits and takes its place if
    it is larger; alt texts of the others are appended unless contained.  The order
    decides, so each request is folded on its own; a request holds a bounded
    queue of images.  Result: scrape_id, ordinal, kept, cluster and, if images have it, alt.
    """
    named = "alt" in images.columns

    def fold(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("ordinal", kind="stable")
        kept: list[list] = []
        clusters = []
        for row in group.itertuples():
            known = row.phash is not None and not pd.isna(row.phash)
            size, mine, alt = (row.area, row.bytes), None, (row.alt or "") if named else ""
            for i, other in enumerate(kept if known else []):
                if other[0] is not None and ((int(row.phash) ^ other[0]) & ((1 << 64) - 1)).bit_count() <= near:
                    mine = i
                    break
            if mine is None:
                kept.append([int(row.phash) if known else None, size, row.ordinal, alt])
                mine = len(kept) - 1
            elif size > kept[mine][1]:
                kept[mine] = [int(row.phash), size, row.ordinal, _joined(alt, kept[mine][3])]
            else:
                kept[mine][3] = _joined(kept[mine][3], alt)
            clusters.append(mine)
        alts = {k[2]: k[3] for k in kept}
        out = {
            "scrape_id": group["scrape_id"].to_numpy(),
            "ordinal": group["ordinal"].to_numpy(),
            "kept": [o in alts for o in group["ordinal"]],
            "cluster": np.array(clusters, dtype="int32"),
        }
        if named:
            out["alt"] = [alts.get(o, a or "") for o, a in zip(group["ordinal"], group["alt"])]
        return pd.DataFrame(out)

    kind = dict(images.dtypes)
    given = images.select("scrape_id", "ordinal", F.col("phash").cast("long"), "area", "bytes", *["alt"] * named)
    given = given.withColumn("phash", F.col("phash").cast("string"))

    def run(group: pd.DataFrame) -> pd.DataFrame:
        group = group.assign(phash=[None if p is None else int(p) for p in group["phash"]])
        return fold(group.astype({"phash": object}))

    schema = f"scrape_id {kind['scrape_id']}, ordinal {kind['ordinal']}, kept boolean, cluster int" + ", alt string" * named
    return given.groupBy("scrape_id").applyInPandas(run, schema)


def prune_by_relevance(images: DataFrame) -> DataFrame:
    """Drop images that are not of the product; unknown ones stay where verdicts are missing for most.

    images: scrape_id, ordinal, relevance (yes, no or empty), retained, description.
    Adds degraded, kept, relevance_final and prune_error.
    """
    by = Window.partitionBy("scrape_id")
    relevance = filled("relevance")
    judged = F.sum((F.col("retained") & relevance.isin("yes", "no")).cast("int")).over(by)
    total = F.sum(F.col("retained").cast("int")).over(by)
    df = images.withColumn("degraded", judged < F.floor(total / 2))
    survives = F.col("retained") & ((relevance == "yes") | ((relevance == "") & F.col("degraded")))
    rich = vision_verdict("description")
    keep = survives & ((rich == "yes") | (relevance == "yes") | ((relevance == "") & F.col("degraded")))
    error = (
        F.when(~F.col("retained"), "")
        .when(keep, "")
        .when(relevance == "no", "unrelated to product (vision verdict: no)")
        .when(~survives, "relevance unverified — dropped fail-closed")
        .when(rich == "no", "unrelated to product (rich-describe verdict)")
        .when(filled("description") == "", "not vision-described; removed from clean images folder")
        .otherwise("vision verdict missing/uncertain; removed from clean images folder")
    )
    final = F.when(keep & ((rich == "yes") | (relevance == "yes")), "yes").when(keep, "unverified_kept").otherwise(relevance)
    return df.withColumns({"kept": keep, "relevance_final": final, "prune_error": error})


def vision_picks(images: DataFrame, most: int = 12) -> DataFrame:
    """The largest images of each request; ties by bytes, then by order."""
    order = Window.partitionBy("scrape_id").orderBy(F.desc("area"), F.desc("bytes"), F.asc("ordinal"))
    return images.withColumn("pick", F.row_number().over(order)).where(F.col("pick") <= most)


def visual_decision(images: DataFrame) -> DataFrame:
    """One row for each request: counts and visual_evidence_status.

    images: scrape_id, retained, relevance, download_source, description, error.
    """
    fallback = F.col("download_source") == "screenshot_fallback"
    kept = F.col("retained")
    clean = kept & (filled("relevance") == "yes") & ~F.coalesce(fallback, F.lit(False))
    counts = images.groupBy("scrape_id").agg(
        F.count("*").alias("image_candidate_count"),
        F.count_if(kept).alias("image_downloaded_count"),
        F.count_if(clean).alias("clean_product_image_count"),
        F.count_if(kept & (filled("description") != "")).alias("vision_described_count"),
        F.count_if(filled("error") != "").alias("image_download_errors"),
        F.coalesce(F.bool_or(kept & fallback), F.lit(False)).alias("screenshot_fallback_used"),
    )
    status = (
        F.when(F.col("clean_product_image_count") >= 1, "final_product_images_available")
        .when(F.col("screenshot_fallback_used"), "screenshot_fallback_only")
        .when(F.col("image_downloaded_count") >= 1, "unverified_images_retained")
        .when(F.col("image_candidate_count") > 0, "image_recovery_failed")
        .otherwise("no_image_candidates")
    )
    return counts.withColumn("visual_evidence_status", status)


def image_error_bucket(error: Column | str) -> Column:
    e = F.lower(filled(error))
    bucket = F.lit("other_image_error")
    for name, words in reversed(vocab.IMAGE_ERROR_RULES):
        bucket = F.when(any_term(e, words), name).otherwise(bucket)
    return F.when(e == "", "no_error").otherwise(bucket)


def _manifests(items: DataFrame) -> DataFrame:
    """One row for each scrape_id with items: histograms of errors and attempts, number of items and files, whether a file is a screenshot.

    A histogram is "bucket:count; …", most common first, ties as first seen.  All come from one aggregate over marks of the items.
    """
    path = filled("local_path")
    of = lambda kind, value, first, file, shot: F.struct(
        F.lit(kind).alias("kind"), value.alias("_b"), first.cast("long").alias("first"), file.alias("file"), shot.alias("shot")
    )
    no = F.lit(False)
    error = of(0, F.when(filled("error") != "", image_error_bucket("error")), F.col("ordinal"), no, no)
    tries = F.transform("attempts", lambda a, k: of(1, a, F.col("ordinal") * 1000 + k, no, no))
    item = of(2, F.lit(None).cast("string"), F.col("ordinal"), path != "", path.contains("screenshot_fallback"))
    marks = F.concat(F.array(item, error), F.coalesce(tries, F.slice(F.array(error), 1, 0)))
    marks = F.filter(marks, lambda m: (m["kind"] == 2) | m["_b"].isNotNull())
    counted = items.select("scrape_id", F.explode(marks).alias("m")).select("scrape_id", "m.*").groupBy("scrape_id", "kind", "_b")
    counted = counted.agg(
        F.count("*").alias("n"), F.min("first").alias("first"), F.count_if("file").alias("files"), F.bool_or("shot").alias("shot")
    )
    one = F.struct((-F.col("n")).alias("m"), "first", "_b")
    found = counted.groupBy("scrape_id").agg(
        *[F.array_sort(F.collect_list(F.when(F.col("kind") == k, one))).alias(name) for k, name in ((0, "_errors"), (1, "_tries"))],
        F.sum(F.when(F.col("kind") == 2, F.col("n"))).alias("image_manifest_item_count"),
        F.sum("files").alias("_files"),
        F.bool_or("shot").alias("_shot"),
    )
    text = lambda c: F.array_join(F.transform(c, lambda x: F.concat(x["_b"], F.lit(":"), -x["m"])), "; ")
    return found.select(
        "scrape_id",
        text("_errors").alias("image_error_buckets"),
        F.get("_errors", F.lit(0))["_b"].alias("image_error_buckets_top"),
        text(F.slice("_tries", 1, 8)).alias("image_attempt_buckets"),
        "image_manifest_item_count",
        "_files",
        "_shot",
    )


#: Columns of image_diagnostics().
DIAGNOSTICS = ("image_failure_bucket", "image_recovery_action", "image_error_buckets", "image_attempt_buckets",
               "image_manifest_item_count", "screenshot_fallback_file_detected")


def image_diagnostics(rows: DataFrame, items: DataFrame) -> DataFrame:
    """Why a request has no clean image, and what to do.

    rows: scrape_id, visual_evidence_status, final_image_count, image_candidate_count,
    image_downloaded_count, screenshot_fallback_used.  items: scrape_id, ordinal,
    local_path, error, attempts (array of "strategy:status").
    """
    df = rows.join(_manifests(items), "scrape_id", "left")
    number = lambda name: F.coalesce(F.col(name).cast("long"), F.lit(0))
    downloaded = F.when(number("image_downloaded_count") != 0, number("image_downloaded_count")).otherwise(number("_files"))
    shot = F.coalesce("_shot", F.lit(False))
    top = F.col("image_error_buckets_top")
    visual = filled("visual_evidence_status")
    ladder = (
        ((visual == "final_product_images_available") & (number("final_image_count") >= 1), F.lit("image_ready"), "ready"),
        (
            (visual == "screenshot_fallback_only") | shot | F.coalesce("screenshot_fallback_used", F.lit(False)),
            F.lit("screenshot_fallback_only"),
            "manual_review_screenshot_or_retry_image_capture",
        ),
        (number("image_candidate_count") == 0, F.lit("no_image_candidates"), "inspect_page_capture_or_gallery_extraction"),
        (downloaded == 0, F.coalesce(top, F.lit("all_image_downloads_failed")), "retry_image_capture_with_stronger_profile"),
        (
            number("final_image_count") == 0,
            F.coalesce(top, F.lit("downloaded_but_no_final_product_image")),
            "review_vision_filtering_or_product_image_selection",
        ),
    )
    bucket, action = F.lit("image_partial_or_unverified"), F.lit("manual_review_images")
    for condition, name, todo in reversed(ladder):
        bucket = F.when(condition, name).otherwise(bucket)
        action = F.when(condition, todo).otherwise(action)
    return df.withColumns(
        {
            "image_failure_bucket": bucket,
            "image_recovery_action": action,
            "image_error_buckets": filled("image_error_buckets"),
            "image_attempt_buckets": filled("image_attempt_buckets"),
            "image_manifest_item_count": number("image_manifest_item_count"),
            "screenshot_fallback_file_detected": shot,
        }
    ).drop("_files", "_shot", "image_error_buckets_top")


#: Extensions of images that are kept as they are, and of content types.  Fixed values.
FINAL_EXTENSIONS = (".jpg", ".jpeg", ".png", ".webp")
MIME_EXTENSIONS = (("image/jpeg", ".jpg"), ("image/jpg", ".jpg"), ("image/png", ".png"), ("image/webp", ".webp"), ("image/gif", ".gif"))
MOST_BYTES = 8_000_000


def checked_payloads(payloads: DataFrame) -> DataFrame:
    """Add error (empty for a sound image), mime, sha8 and extension to downloaded images.

    payloads: content, content_type, status, last_error, decoded_format (what a decoder says of the
    bytes, null if it can't read them).  Checks in order: nothing there, too large, not an image by its type, vector
    graphics, undecodable.  Sound images of other formats are to be converted to PNG: `converts`.
    """
    mime = F.lower(F.trim(F.regexp_extract(filled("content_type"), "^([^;]*)", 1)))
    size = F.length("content")
    code = F.coalesce("status", F.lit(0))
    nothing = F.coalesce(F.nullif(filled("last_error"), F.lit("")), F.when(code != 0, F.concat(F.lit("http "), code)), F.lit("download failed"))
    error = (
        F.when(F.coalesce(size, F.lit(0)) == 0, nothing)
        .when(size > MOST_BYTES, F.format_string("too large (%d bytes)", size))
        .when((mime != "") & ~mime.startswith("image/"), F.format_string("non-image response mime=%s status=%d", mime, code))
        .when(mime == "image/svg+xml", "svg/vector image excluded from final product image set")
        .when(filled("decoded_format") == "", "invalid image payload: UnidentifiedImageError")
        .otherwise("")
    )
    extension = F.lit(None).cast("string")
    for kind, name in MIME_EXTENSIONS:
        extension = F.when(mime == kind, name).otherwise(extension)
    decoded = F.lower(filled("decoded_format"))
    extension = F.coalesce(extension, F.when(decoded.isin("jpeg", "jpg"), ".jpg").when(decoded != "", F.concat(F.lit("."), decoded)), F.lit(""))
    df = payloads.withColumns({"error": error, "mime": mime, "sha8": F.when((size > 0) & (size <= MOST_BYTES), content_hash("content")), "_e": extension})
    sound = F.col("error") == ""
    converts = sound & ~F.col("_e").isin(*FINAL_EXTENSIONS)
    return df.withColumns(
        {
            "converts": converts,
            "extension": F.when(~sound, "").when(converts, ".png").otherwise(F.col("_e")),
            "mime": F.when(converts, "image/png").when(F.col("error").startswith("too large"), "").otherwise(F.col("mime")),
        }
    ).drop("_e")


def manifest_items(manifest: Column) -> Column:
    """The image items of a manifest given as a variant: an array, or the first array under one of four keys, objects only."""
    keys = ("images", "items", "image_refs", "candidates")
    inner = [F.try_variant_get(manifest, f"$.{k}", "array<variant>") for k in keys]
    whole = F.when(F.schema_of_variant(manifest).startswith("ARRAY"), F.try_variant_get(manifest, "$", "array<variant>"))
    found = F.coalesce(whole, *inner, F.array().cast("array<variant>"))
    return F.filter(found, lambda v: F.schema_of_variant(v).startswith("OBJECT"))


def top_errors(images: DataFrame, most: int = 3) -> DataFrame:
    """(scrape_id, place, bucket, n): the most common errors, cut at the first colon and 40 characters, ties as first seen."""
    bucket = F.left(F.regexp_extract(filled("error"), r"^([^:]*)", 1), F.lit(40))
    counted = images.where(filled("error") != "").groupBy("scrape_id", bucket.alias("bucket"))
    counted = counted.agg(F.count("*").alias("n"), F.min("ordinal").alias("first"))
    place = F.row_number().over(Window.partitionBy("scrape_id").orderBy(F.desc("n"), "first"))
    return counted.withColumn("place", place).where(F.col("place") <= most).select("scrape_id", "place", "bucket", "n")


def retry_batches(refs: Column, thumbs: Column, alts: Column, verdicts: Column) -> Column:
    """The images of a batch that have no verdict yet, each with its thumbnail and alt text, by position."""
    zipped = F.arrays_zip(refs.alias("ref"), thumbs.alias("thumb"), alts.alias("alt"), verdicts.alias("verdict"))
    return F.filter(zipped, lambda z: filled(z["verdict"]) == "")


def select_images(candidates: DataFrame, most: int = 30, describe: int = 12, near: int = NEAR) -> DataFrame:
    """The whole way from candidates to clean images: queue, content and near duplicates, relevance, picks, verdict.

    candidates: scrape_id, ordinal, url, alt and, by URL, what downloading and models gave: sha8 (null:
    not retained), phash, width, height, bytes, relevance, description, download_source, error.  One row
    for each queued image: position, alt (with those of its duplicates), duplicate, described, kept, relevance_final.
    """
    facts = [c for c in candidates.columns if c not in ("scrape_id", "url", "alt", "ordinal")]
    first = candidates.groupBy("scrape_id", "url").agg(F.min_by(F.struct(*facts), "ordinal").alias("f"))
    queue = image_queue(candidates, most).drop("ordinal").join(first.select("scrape_id", "url", "f.*"), ["scrape_id", "url"])
    queue = queue.withColumnRenamed("position", "ordinal").withColumn("area", F.col("width") * F.col("height"))
    there = queue.where("sha8 is not null")
    single = exact_duplicates(there).select("scrape_id", "ordinal", "alt")
    survivors = there.drop("alt").join(single, ["scrape_id", "ordinal"])
    kept = near_duplicates(survivors, near).where("kept").select("scrape_id", "ordinal", F.col("alt").alias("alt_joined"))
    df = queue.join(kept.withColumn("retained", F.lit(True)), ["scrape_id", "ordinal"], "left")
    df = df.withColumns({"retained": F.coalesce("retained", F.lit(False)), "alt": F.coalesce("alt_joined", "alt")}).drop("alt_joined")
    duplicate = F.col("sha8").isNotNull() & ~F.col("retained")
    picks = vision_picks(df.where("retained"), describe).select("scrape_id", "ordinal", F.lit(True).alias("described"))
    df = df.withColumn("duplicate", duplicate).join(picks, ["scrape_id", "ordinal"], "left")
    df = df.withColumn("described", F.coalesce("described", F.lit(False)))
    df = df.withColumn("description", F.when(F.col("described"), filled("description")).otherwise(""))
    return prune_by_relevance(df).withColumnRenamed("ordinal", "position")
