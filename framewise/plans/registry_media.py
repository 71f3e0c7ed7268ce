"""Image, feature, incremental and model queries (registered on import)."""

from __future__ import annotations

from pyspark.sql import functions as F

from framewise.functions.columns import basename
from framewise.operators import features as FT
from framewise.operators import images as IM
from framewise.plans import registry
from framewise.plans import tables as TB
from framewise.plans.registry import query
from framewise.sources import bindings as B
from framewise.sources import catalog as SC
from framewise.streaming import incremental as INC


def _docs(spark, d):
    return B.image_documents(TB.table(spark, d, "embeddings"))


def _density(spark, d):
    return FT.traffic_density(FT.pixel_foreground(TB.pixels(spark, d)))


def _density_features(spark, d):
    """Per-frame density keyed like the image documents."""
    dens = _density(spark, d)
    return dens.select((F.col("video") * 50 + F.col("frame")).alias("image_id"),
                       IM.image_key(F.col("video") + 1, F.col("frame") + 1).alias("filename"),
                       "traffic_density")


@query("image_manifest")
def _image_manifest(spark, d):
    videos = _docs(spark, d).select("video")
    return IM.image_manifest(videos)


@query("missing_images")
def _missing_images(spark, d):
    docs = _docs(spark, d)
    stored = docs.where(F.col("image_id") % 7 != 0)
    return IM.missing_images(IM.image_manifest(docs.select("video")), stored)


@query("basename")
def _basename(spark, d):
    return TB.table(spark, d, "pages").select("page_id", basename("url").alias("filename"))


@query("field_defaults")
def _field_defaults(spark, d):
    docs = B.customer_documents(TB.table(spark, d, "customer"))
    return IM.field_defaults(docs).select("c_custkey", "filename", "has_payload")


@query("unprocessed_filter")
def _unprocessed_filter(spark, d):
    return IM.unprocessed(_docs(spark, d)).select("image_id", "filename", "processed")


@query("next_batch")
def _next_batch(spark, d):
    return INC.next_batch(_docs(spark, d)).select("image_id", "filename", "processed")


@query("pixel_foreground")
def _pixel_foreground(spark, d):
    return FT.pixel_foreground(TB.pixels(spark, d))


@query("pixel_foreground_chunks")
def _pixel_foreground_chunks(spark, d):
    """The same test over chunks of eight frames, each led by its history."""
    return FT.pixel_foreground(TB.pixels(spark, d), chunk=8)


@query("traffic_density")
def _traffic_density(spark, d):
    return _density(spark, d)


@query("feature_upsert")
def _feature_upsert(spark, d):
    feats = _density_features(spark, d)
    base = feats.withColumn("traffic_density", F.lit(0.0))
    updates = feats.where(F.col("image_id") % 2 == 0)
    return INC.upsert_latest(base, updates, "image_id")


def _processed_inputs(spark, d):
    """The image documents and the features of every second one, as catalog tables in buckets of the image id."""
    docs = registry._catalog_table(spark, _docs(spark, d), "image_documents", "image_id")
    feats = registry._catalog_table(spark, _density_features(spark, d).where("image_id % 2 = 0"), "image_features", "image_id")
    return SC.scan_catalog(spark, docs), SC.scan_catalog(spark, feats)


@query("processed_flag")
def _processed_flag(spark, d):
    return INC.mark_processed(*_processed_inputs(spark, d)).select("image_id", "filename", "processed")


@query("batch_progress")
def _batch_progress(spark, d):
    todo = IM.unprocessed(_docs(spark, d))
    batches = (todo.groupBy(F.expr("image_id div 10").alias("batch_id"))
               .agg(F.count(F.lit(1)).alias("processed")))
    return INC.running_total(batches, "batch_id", "processed")


# ------------------------------------------------------------ image files

@TB.once
def _image_dir(spark, d, where: str = "true") -> str:
    """Write the embedding frames (those ``where`` keeps) as PNG objects under the shared folder."""
    from framewise.session import shared_dir
    from framewise.sources import images as SI
    rows = B.frame_image_rows(TB.table(spark, d, "embeddings").where(where))
    return SI.write_frame_images(rows, shared_dir(spark, "frames"))


def _decoded_rows(spark, d):
    from framewise.sources import images as SI
    return SI.image_rows(SI.decode_images(spark, _image_dir(spark, d)))


def _pixels_sha256(data="data"):
    return F.sha2(F.hex(data).cast("binary"), 256).alias("pixels_sha256")


@query("scan_images")
def _scan_images(spark, d):
    """The files' bytes: signature, header and size fields, and whether the end mark is there."""
    from framewise.sources import images as SI
    content = F.hex("content")
    return SI.scan_images(spark, _image_dir(spark, d)).select(
        basename("path").alias("filename"), F.substring(content, 1, 48).alias("head"),
        content.endswith("0000000049454E44AE426082").alias("complete"))


@query("decode_images")
def _decode_images(spark, d):
    return _decoded_rows(spark, d).select("filename", "height", "width", "nChannels", "mode", _pixels_sha256())


@query("list_images")
def _list_images(spark, d):
    from framewise.sources import images as SI
    listed = SI.list_images(spark, _image_dir(spark, d))
    return listed.select("filename", (F.col("length") > 0).alias("has_bytes"),
                         F.col("modificationTime").isNotNull().alias("has_time"))


@TB.once
def _ingested(spark, d):
    from framewise.session import shared_dir
    from framewise.sources import images as SI
    table = shared_dir(spark, "image_table")
    src = _image_dir(spark, d)
    SI.ingest_images(spark, src, table)
    SI.ingest_images(spark, src, table, skip_existing=True)  # re-run adds nothing
    return SI.scan_image_table(spark, table)


@query("ingest_images")
def _ingest_images(spark, d):
    return _ingested(spark, d).select("filename", "height", "width", "nChannels", "mode", "processed")


@query("scan_image_table")
def _scan_image_table(spark, d):
    return IM.unprocessed(_ingested(spark, d)).select("filename", "height", "width")


@query("image_profile")
def _image_profile(spark, d):
    from framewise.sources import images as SI
    return IM.image_profile(SI.decode_images(spark, _image_dir(spark, d)))


@query("bad_images")
def _bad_images(spark, d):
    from framewise.sources import images as SI
    _, bad = IM.split_decoded(SI.decode_images(spark, _image_dir(spark, d)))
    return bad.select("filename", "reason")  # the full path differs per run


@query("resize_images")
def _resize_images(spark, d):
    from framewise.operators.resize import resize_images
    return resize_images(_decoded_rows(spark, d)).where("status = 'ok'").select(
        "filename", "height", "width", "nChannels", _pixels_sha256())


@query("frame_features")
def _frame_features(spark, d):
    rows = _decoded_rows(spark, d).where("height > 0")
    frames = rows.select(*IM.parse_image_key("filename"), "*")
    return FT.frame_features(frames).drop("processing_timestamp")


# ------------------------------------------------------------------- model

def _training_rows(spark, d):
    return B.severity_training_rows(TB.records(spark, d))


@TB.once
def _stored_training_rows(spark, d) -> str:
    """The training rows written down: the split, the fit's passes and the scoring read five narrow columns."""
    from framewise.session import shared_dir
    from framewise.sources import sinks as SK
    return SK.sink_parquet(_training_rows(spark, d), shared_dir(spark, "severity_rows"))


@query("ml_split")
def _ml_split(spark, d):
    from framewise.operators.model import ml_split
    train, test = ml_split(_training_rows(spark, d))
    return (train.withColumn("split", F.lit("train"))
            .unionByName(test.withColumn("split", F.lit("test"))))


@TB.once
def _severity(spark, d):
    """(test rows, fitted model, its predictions of them)."""
    from framewise.operators.model import ml_split, predict, train_severity_model
    train, test = ml_split(spark.read.parquet(_stored_training_rows(spark, d)))
    model = train_severity_model(train)
    return test, model, predict(model, test)


@query("severity_model")
def _severity_model(spark, d):
    _, _, predicted = _severity(spark, d)
    return predicted.select("sequence_id", "crash_severity", "prediction")


@query("severity_nodes")
def _severity_nodes(spark, d):
    """The forest as a node table, scored by joins: does it say what the model says, for every test row?"""
    from framewise.operators import model as ML
    from framewise.session import shared_dir
    test, model, predicted = _severity(spark, d)
    nodes = ML.forest_nodes(model, shared_dir(spark, "severity_nodes"))
    scored = ML.score_with_nodes(test, nodes, ML.feature_codes(model), ML.forest_size(model)).withColumnRenamed("prediction", "scored")
    return predicted.join(scored, "sequence_id", "left").select(
        "sequence_id", F.col("prediction").eqNullSafe(F.col("scored")).alias("agrees"))


@query("model_accuracy")
def _model_accuracy(spark, d):
    from framewise.operators.model import model_accuracy
    _, _, predicted = _severity(spark, d)
    return model_accuracy(predicted)


# ---------------------------------------------------------------- streaming

@query("incremental_features")
def _incremental_features(spark, d):
    from framewise.session import shared_dir
    from framewise.streaming import features_stream as FS
    root = shared_dir(spark, "incremental")
    rows = B.frame_image_rows(TB.table(spark, d, "embeddings")).select(*FS.IMAGE_ROW_SCHEMA.fieldNames())
    src = FS.write_chunks(rows, f"{root}/source", rows_per_file=10)
    feats, prog, ckpt = f"{root}/features", f"{root}/progress", f"{root}/checkpoint"
    FS.run_incremental_features(spark, src, feats, prog, ckpt, files_per_trigger=5)
    # A restart on the same checkpoint finds no new files and adds nothing.
    FS.run_incremental_features(spark, src, feats, prog, ckpt, files_per_trigger=5)
    return spark.read.parquet(feats).select(F.col("video").cast("long").alias("video"), "frame", "filename", "traffic_density")


@query("incremental_density")
def _incremental_density(spark, d):
    from framewise.session import shared_dir
    from framewise.streaming import features_stream as FS
    root = shared_dir(spark, "incremental_density")
    rows = TB.table(spark, d, "embeddings").withColumn("video", F.expr("vec_id div 50"))
    src = FS.write_chunks(rows.select("vec_id", "embedding", "label", "video"), f"{root}/source", 10)
    FS.run_incremental_density(spark, src, f"{root}/table", f"{root}/progress", f"{root}/checkpoint",
                               files_per_trigger=5)
    return spark.read.parquet(f"{root}/table").select("video", "frame", "traffic_density")


@TB.once
def _folder_features(spark, d):
    """Ingest the image folder, extract, and run both again: the second run finds nothing new."""
    from framewise.plans import jobs as J
    from framewise.session import shared_dir
    folder, root = _image_dir(spark, d), shared_dir(spark, "folder_features")
    for _ in range(2):
        J.ingest_job(spark, folder, f"{root}/images", images_per_file=200)
        J.feature_job(spark, f"{root}/images", root, files_per_trigger=8, block=1, state_partitions=8)
    return root


@query("incremental_image_features")
def _incremental_image_features(spark, d):
    from framewise.plans import jobs as J
    feats = J.read_features(spark, _folder_features(spark, d))
    return feats.select("video", "frame", basename("path").alias("filename"), "traffic_density")


@query("image_progress")
def _image_progress(spark, d):
    """Stored and failed files over a folder that holds damaged ones."""
    root = _folder_features(spark, d)
    return (spark.read.parquet(f"{root}/progress")
            .agg(F.sum("processed").alias("processed"), F.sum("failed").alias("failed")))


@query("upsert_table")
def _upsert_table(spark, d):
    """The keyed log: a first write, an upsert of every second row handed in twice, a compaction, one more upsert."""
    from framewise.session import shared_dir
    from framewise.sources.keyed_log import KeyedLog
    log = KeyedLog(spark, shared_dir(spark, "upsert_table"), "image_id")
    feats = _density_features(spark, d)
    log.upsert(feats.withColumn("traffic_density", F.lit(-1.0)), "stream", 0)
    for _ in range(2):
        log.upsert(feats.where("image_id % 2 = 0"), "stream", 1)
    log.compact()
    log.upsert(feats.where("image_id % 2 = 1").withColumn("traffic_density", F.lit(0.0)), "stream", 2)
    return log.read()


# ---------------------------------------------------------- document dumps

@query("scan_dump_records")
def _scan_dump_records(spark, d):
    """The record collection written as a dump and scanned in small splits."""
    from framewise.session import shared_dir
    from framewise.sources import bson_dump as BD
    records = TB.records(spark, d)
    path = BD.write_dump(records, shared_dir(spark, "dump"))
    return BD.scan_dump(spark, path, records.schema, split_bytes=1 << 16).drop("sequence_id")


@query("scan_dump_images")
def _scan_dump_images(spark, d):
    """The image collection as a dump: the unprocessed documents, filtered while the dump is read."""
    from framewise.session import shared_dir
    from framewise.sources import bson_dump as BD
    embeddings = TB.table(spark, d, "embeddings")
    docs = B.image_documents(embeddings).select("image_id", "filename", "processed")
    pixels = B.frame_image_rows(embeddings).select(
        ((F.col("video") - 1) * 50 + F.col("frame") - 1).alias("image_id"), F.col("data").alias("image"))
    path = BD.write_dump(docs.join(pixels, "image_id"), shared_dir(spark, "dump"))
    scanned = BD.scan_dump(spark, path, "image_id long, filename string, processed boolean, image binary", 1 << 16)
    return IM.unprocessed(scanned).select("image_id", "filename", "processed", _pixels_sha256("image"))
