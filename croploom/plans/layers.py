"""The layer job: from source rows of many layers to exported layers, with a report."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from croploom.functions import geometry as G
from croploom.functions.scalars import layer_name
from croploom.functions.wkb import from_wkb
from croploom.operators.columns import area_ha, hold
from croploom.operators.joins import dim_join
from croploom.operators.ledger import layer_digests, number_keyed, row_digest
from croploom.operators.quality import repair_layer
from croploom.operators.stats import reconcile
from croploom.session import materialise, scratch
from croploom.sources.sinks import encoded, export_layers, replace_layers, write_report
from croploom.streaming.incremental import layers_changed

# Standard columns that a manifest can name, and their types.
STANDARD = {"off_id": "string", "off_area": "double", "original_code": "string"}


@dataclass(frozen=True)
class LayerProducts:
    """All are read from what the job has written."""

    layers: DataFrame
    quarantine: DataFrame
    report: DataFrame
    digests: DataFrame


def harmonised(sources: DataFrame, manifest: DataFrame) -> DataFrame:
    """Source rows with the standard columns, by each layer's manifest.

    sources: nuts, year, attrs (map of source column names to text), wkb.  The names are compared
    without regard to case.  Of several source columns for one standard column the first by name that
    has a value counts; a layer without manifest has no standard values.
    """
    kept = manifest.where("tokeep = 1").select(
        F.lower("nuts").alias("nuts"), "year", F.col("type").alias("standard"), F.lower("column_name").alias("source")
    )
    kept = kept.groupBy("nuts", "year").agg(F.sort_array(F.collect_set(F.struct("standard", "source"))).alias("_names"))
    rows = dim_join(sources.withColumn("nuts", F.lower("nuts")), kept, ["nuts", "year"], "left")
    rows = rows.withColumn("attrs", F.transform_keys("attrs", lambda k, _: F.lower(k)))
    pick = "element_at(filter(transform(filter(_names, n -> n.standard = '{}'), n -> attrs[n.source]), v -> v is not null), 1)"
    value = "try_cast(if(size({p}) > 0, {e}, null) as {t})"
    out = {}
    for name, kind in STANDARD.items():
        e = pick.format(name)
        out[name] = F.expr(value.format(p=e[len("element_at(") : -len(", 1)")], e=e, t=kind))
    return rows.select("nuts", "year", *[c.alias(n) for n, c in out.items()], "wkb")


def layer_job(sources: DataFrame, import_list: DataFrame, manifest: DataFrame, out: str, done: DataFrame | None = None) -> LayerProducts:
    """Take in all layers of the import list at once, but those named in ``done`` (nuts, year).

    Harmonises columns, decodes and repairs geometries, numbers the parcels of each layer, computes
    areas, and exports one folder per layer below ``out``; rows without a usable geometry are written
    to quarantine with a reason.  Numbers come from a ledger below ``out``: a row that was there in an
    earlier run has the number it had.  The report has a row per listed layer: rows in the source,
    exported and missing, and whether the layer is complete, partial, missing, or was there before, whole
    or in part.

    ``done`` may have a ``digest`` as well, as in the ``digests`` of an earlier run: then a listed layer
    whose source rows have changed since is taken in again.  All that is written is written by layer
    and replaces what an earlier run has left of it, so a run that failed can be repeated.
    """
    spark = sources.sparkSession
    listed = import_list.select(F.lower("nuts").alias("nuts"), "year").distinct()
    rows = sources.withColumn("nuts", F.lower("nuts"))
    name = layer_name(F.col("nuts"), F.col("year")).alias("layer")
    with scratch(spark):
        listed = materialise(listed, "listed", counted=True)
        asked = dim_join(rows, listed, ["nuts", "year"], "left_semi")
        digests = materialise(layer_digests(asked.select("nuts", "year", "attrs", "wkb")), "digests")
        wanted = listed
        if done is not None:
            known = done.withColumn("nuts", F.lower("nuts")).select(*[c for c in ("nuts", "year", "digest") if c in done.columns]).distinct()
            if "digest" in known.columns:
                changed = layers_changed(digests, known).select("nuts", "year", F.lit(True).alias("_changed"))
                known = known.join(changed, ["nuts", "year"], "left").where("_changed is null").select("nuts", "year")
            known = materialise(known, "done")
            wanted = materialise(listed.join(known, ["nuts", "year"], "left_anti"), "wanted", counted=True)
        todo = dim_join(rows, wanted, ["nuts", "year"], "left_semi")
        raw = harmonised(todo, manifest).withColumn("_wkb", F.md5("wkb"))
        raw = raw.withColumn("_key", row_digest("off_id", "off_area", "original_code", "_wkb")).withColumn("geom", from_wkb("wkb"))
        fixed = hold(repair_layer(raw.drop("wkb", "_wkb")), "geom", F.col("geom"))
        reason = (
            F.when(F.col("geom").isNull(), "no readable geometry")
            .when(F.size("geom") == 0, "empty geometry")
            .when(F.col("method") == 9, "could not be repaired")
        )
        fixed = fixed.withColumn("reason", reason).withColumn("_good", F.when(F.col("reason").isNull(), F.col("geom")))
        # Good geometries are stored as they are exported, which moves them as bytes; the others as they came.
        fixed = encoded(fixed, "_good").withColumns(
            {"area_ha": area_ha(G.area(F.col("_good"))), "geom": F.when(F.col("reason").isNotNull(), F.col("geom"))}
        )
        fixed = materialise(fixed.drop("_good", "method"), "layers")
        bad = fixed.where("reason is not null").drop("_key", "bbox", "geometry", "area_ha")
        replace_layers(bad, f"{out}/quarantine", wanted)
        good = number_keyed(fixed.where("reason is null").drop("reason", "geom"), f"{out}/keys")
        export_layers(good, f"{out}/layers")
        replace_layers(digests, f"{out}/digests", listed)
        present = None
        if done is not None:
            there = spark.read.parquet(f"{out}/layers").select(F.col("nuts").cast("string").alias("nuts"), F.col("year").cast("int").alias("year"))
            there = there.groupBy("nuts", "year").agg(F.count(F.lit(1)).alias("n_present"))
            present = known.join(there, ["nuts", "year"], "left").select(name, "n_present")
        report = reconcile(asked.select(name), fixed.where("reason is null").select(name), "layer", present)
        path = write_report(report, f"{out}/report", "layers.csv", stamp="%Y%m%d%H%M%S%f")
    read = lambda df, sub: spark.read.schema(df.schema).parquet(f"{out}/{sub}")
    return LayerProducts(
        layers=spark.read.parquet(f"{out}/layers"),
        quarantine=read(bad, "quarantine"),
        report=spark.read.option("header", True).schema(report.schema).csv(path),
        digests=read(digests, "digests"),
    )
