"""Runs that the configuration table drives: every movie under its own settings."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from castframe.plans.tagging import TaggingRun, settings_table
from castframe.sources.frames import walk_frames


class ConfiguredRun:
    """One run over all configured movies. Their settings are columns, so each stage is one job over all of them.

    What a stage cannot take, such as a model without a factory or vectors of unequal
    length, fails its movie alone; the others go on. ``list_roots`` turns (movie, folder) into a listing.
    """

    def __init__(
        self, spark: SparkSession, config: DataFrame, folder: str, list_roots: Callable[[DataFrame], DataFrame] = walk_frames
    ):
        self.config = config
        self.frames = list_roots(config.select("movie", F.col("frames_dir").alias("folder")))
        self.stages = TaggingRun(spark, folder, settings_table(config))

    def run(
        self,
        gallery: DataFrame,
        actors: DataFrame,
        detector_factory: Callable[[], Any],
        embedder_factories: Mapping[str, Callable[[], Any]],
        read_image: Callable[[str], Any],
        write_image: Callable[[str, Any], None] | None = None,
    ) -> "ConfiguredRun":
        self.stages.run(self.frames, gallery, actors, detector_factory, embedder_factories, read_image, write_image)
        return self

    def table(self, name: str) -> DataFrame:
        return self.stages.table(name)

    def errors(self) -> DataFrame:
        return self.stages.errors()

    def status(self) -> DataFrame:
        return self.stages.status(self.config, self.frames)
