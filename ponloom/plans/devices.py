"""The device table kept in step with the configuration."""

from __future__ import annotations

from pyspark.sql import DataFrame

from ponloom.operators.upkeep import upsert
from ponloom.sources.config import config_devices, overlay_config

# What a configuration may change on a known device. The vendor is not among it.
SYNCED = ["host", "port", "poll_interval", "prompt", "description"]


def sync_devices(olt: DataFrame, config: DataFrame) -> DataFrame:
    """The device table after a configuration was read: new devices added, known ones updated.

    Devices that left the configuration stay. Of a device that a configuration names several times the later settings count.
    """
    return upsert(olt, config_devices(overlay_config(config)), ["id"], SYNCED, order_by="place")
