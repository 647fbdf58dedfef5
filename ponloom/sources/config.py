"""Device configuration: shared defaults under per-device settings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ponloom.schemas import DEFAULT_POLL_INTERVAL, OLT

# Settings that never leave this module.
SECRETS = ["username", "password", "snmp_community"]


def read_config(spark: SparkSession, path: str) -> DataFrame:
    """JSON documents ``{"defaults": {...}, "olts": [{...}]}``; nested values stay JSON text."""
    shape = "defaults map<string,string>, olts array<map<string,string>>"
    return spark.read.schema(shape).option("multiLine", True).json(path)


def overlay(defaults: Column, device: Column) -> Column:
    """A device's settings over the defaults. A key the device has wins, even with a NULL value."""
    kept = F.map_filter(defaults, lambda k, _: ~F.map_contains_key(device, k))
    return F.coalesce(F.map_concat(kept, device), device)


def overlay_config(config: DataFrame) -> DataFrame:
    """One row per device entry: its ``id``, ``settings`` without secrets and its ``place`` in the list."""
    devices = config.select("defaults", F.posexplode("olts").alias("place", "device"))
    settings = F.map_filter(overlay(F.col("defaults"), F.col("device")), lambda k, _: ~k.isin(SECRETS))
    return devices.select(F.col("device")["id"].alias("id"), settings.alias("settings"), "place")


def config_devices(devices: DataFrame) -> DataFrame:
    """Rows of the device table from ``overlay_config``, with their place."""
    s = F.col("settings")
    wide = devices.select(*[
        F.col("id") if f.name == "id" else s[f.name].try_cast(f.dataType).alias(f.name) for f in OLT.fields
    ], "place")
    return wide.fillna(DEFAULT_POLL_INTERVAL, ["poll_interval"])


def scan_scopes(devices: DataFrame) -> DataFrame:
    """The reads one poll of a device makes: ``(olt_id, vendor, scope)``.

    Ports as ``slot/port`` for huawei, slots (``filters``, else ``slots``, else slot 1) for
    zyxel1240XA, and the whole device ``*`` for the others.
    """
    s = F.col("settings")
    ports = F.from_json(s["pon_list"], "array<struct<slot:string,port:string>>")
    slots = [F.nullif(F.from_json(s[k], "array<string>"), F.array().cast("array<string>")) for k in ("filters", "slots")]
    scopes = (
        F.when(s["vendor"] == "huawei", F.transform(
            ports, lambda p: F.concat(p["slot"].try_cast("int").cast("string"), F.lit("/"), p["port"].try_cast("int").cast("string"))
        ))
        .when(s["vendor"] == "zyxel1240XA", F.coalesce(*slots, F.array(F.lit("1"))))
        .otherwise(F.array(F.lit("*")))
    )
    return devices.select(F.col("id").alias("olt_id"), s["vendor"].alias("vendor"), F.explode(scopes).alias("scope"))
