"""The batch pipeline: five numbered, timed stages with a file between each two.

A manifest in the output folder says what each stage read and left; run(reuse=True) skips stages that are still fresh.
"""

from __future__ import annotations

import functools
import logging
import time
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import tables
from ..operators import aggregate as A
from ..operators import checks, encode, geocode, polygons, spatial
from ..operators.standardize import categorise, enrich_units, standardize, unit_dimensions
from ..scope import Scope
from ..sources import files, json_files
from ..sources.xlsx import XlsxSource
from ..sources.zipcsv import read_addresses
from .manifest import Manifest

LOG = logging.getLogger("terracover")


class StageFailed(Exception):
    """A stage ended with an error, which is the cause of this one."""

    def __init__(self, number: int, title: str, cause: BaseException):
        super().__init__(f"stage {number} ({title}) failed: {cause}")
        self.number, self.title = number, title


@dataclass
class Inputs:
    """Where the source files are; names and population are optional."""

    branches: str
    posts: str
    boundaries: list[str]
    addresses: str
    names: list[str] = field(default_factory=list)
    population: list[str] = field(default_factory=list)


def run_stages(stages: list[tuple[str, Callable[[], object]]]) -> list[tuple[str, float]]:
    """Run stages in order; the time of each, or StageFailed."""
    times = []
    for k, (title, stage) in enumerate(stages, 1):
        began = time.monotonic()
        LOG.info("stage %d of %d: %s", k, len(stages), title)
        try:
            stage()
        except Exception as e:
            raise StageFailed(k, title, e) from e
        times.append((title, time.monotonic() - began))
    return times


class Pipeline:
    def __init__(self, spark: SparkSession, scope: Scope, inputs: Inputs, out: str):
        self.spark, self.scope, self.inputs, self.out = spark, scope, inputs, out
        self.manifest = Manifest(spark, f"{out}/manifest_{scope.slug}")
        spark.dataSource.register(XlsxSource)

    def path(self, kind: str) -> str:
        return self.scope.path(self.out, kind)

    def register(self, path: str, kind: str, rank: int) -> DataFrame:
        """One register, standardised."""
        return standardize(self.spark.read.format("xlsx").load(path), kind, path.rsplit("/", 1)[-1], rank)

    def categorised(self) -> None:
        rows = categorise([self.register(self.inputs.branches, "Agência", 0), self.register(self.inputs.posts, "Posto de Atendimento", 1)], self.scope)
        files.write_table(rows, self.path("categorised"))
        if bad := checks.unclassified(self.spark.read.parquet(self.path("categorised"))).count():
            raise ValueError(f"{bad} rows without a category or brand")

    def units(self) -> DataFrame:
        """Boundaries of the scope with dimensions, names and population, by code."""
        raw = unit_dimensions(json_files.read_boundaries(self.spark, *self.inputs.boundaries))
        raw = polygons.repair(raw.where(self.scope.contains(F.col("uf"))))
        names = json_files.read_unit_names(self.spark, *self.inputs.names) if self.inputs.names else None
        people = json_files.read_population(self.spark, *self.inputs.population) if self.inputs.population else None
        return enrich_units(raw, names, people).orderBy("municipio_ibge")

    def boundaries(self) -> None:
        files.write_geo(self.units().drop("valida"), self.path("boundaries"))
        units = files.read_geo(self.spark, self.path("boundaries"))
        json_files.check_collection(units)
        if twice := checks.duplicate_keys(units, "municipio_ibge").count():
            raise ValueError(f"{twice} unit codes occur more than once")
        if bad := checks.bad_codes(units).count():
            raise ValueError(f"{bad} malformed unit codes")
        for row in checks.incomplete_states(units, list(self.scope.states)).collect():  # one row a state at most
            LOG.warning("%s has %d units, expected %d", row["uf"], row["found"], row["expected"])

    def aggregated(self) -> None:
        points = self.spark.read.parquet(self.path("categorised"))
        units = files.read_geo(self.spark, self.path("boundaries"))
        wide = A.pivot_counts(A.count_points(points.where(F.col("municipio_ibge").isNotNull())))
        out = A.join_detail(A.join_dimension(units, wide), A.bucket_detail(points))
        files.write_geo(out, self.path("aggregate"))
        totals = [c for c in wide.columns if c not in ("municipio_ibge", "total_geral", "total_cooperativas", "total_bancos")]
        if wrong := checks.unreconciled(self.spark.read.parquet(self.path("aggregate")), "total_geral", ["total_cooperativas", "total_bancos"], totals).count():
            raise ValueError(f"{wrong} units whose totals do not add up")

    def geocoded(self) -> None:
        target = geocode.address_keys(self.spark.read.parquet(self.path("categorised")))
        # units that points lie in: at most the country's, so the scan itself leaves out all other rows
        asked = [r[0] for r in target.where(F.col("municipio_ibge").isNotNull()).select("municipio_ibge").distinct().collect()]
        raw = read_addresses(self.spark, self.inputs.addresses).where(F.col("COD_MUNICIPIO").isin(asked))
        units = files.read_geo(self.spark, self.path("boundaries"))
        found = geocode.locate(target, geocode.build_index(target, geocode.reference_addresses(raw)))
        placed, _ = spatial.place(found, units)
        files.write_geocoded(spatial.revert_outside(spatial.fan_out(placed), units), self.path("geocoded"))

    def mapped(self) -> None:
        """Stage 5: the dictionary-encoded payload of the points, in panel order."""
        points = encode.emission_order(self.spark.read.parquet(self.path("geocoded")), list(tables.BRAND_SUFFIX))
        coded, dictionaries = encode.encode(points, ["nome_instituicao", "tipo_instalacao", "municipio", "uf", "bairro", "cep", "numero", "precisao", "marca_exibicao"], ["nome_instalacao", "endereco"])
        files.payload(coded, dictionaries, self.path("map"))

    def stages(self) -> list[tuple[str, Callable[[], None], list[str], list[str]]]:
        """Title, function, inputs and outputs of each stage."""
        i = self.inputs
        points, units, aggregate, geocoded = (self.path(k) for k in ("categorised", "boundaries", "aggregate", "geocoded"))
        return [
            ("registers", self.categorised, [i.branches, i.posts], [points]),
            ("boundaries", self.boundaries, [*i.boundaries, *i.names, *i.population], [units]),
            ("aggregate", self.aggregated, [points, units], [aggregate]),
            ("geocode", self.geocoded, [points, units, *i.addresses.split(",")], [geocoded]),
            ("map payload", self.mapped, [geocoded], [self.path("map")]),
        ]

    def run(self, reuse: bool = False) -> list[tuple[str, float]]:
        """Run the stages, or with reuse those that are not fresh; the time of each (a skipped one takes none)."""
        self.skipped: list[str] = []

        def tracked(number: int, title: str, stage: Callable[[], None], inputs: list[str], outputs: list[str]) -> None:
            if reuse and self.manifest.fresh(number, inputs, outputs):
                self.skipped.append(title)
                return
            began = time.monotonic()
            self.manifest.begin(number)
            stage()
            left = outputs[0]
            rows = (self.spark.read.text(f"{left}/points") if title == "map payload" else self.spark.read.parquet(left)).count()
            self.manifest.end(number, title, time.monotonic() - began, inputs, outputs, rows)

        return run_stages([(title, functools.partial(tracked, k, title, *rest)) for k, (title, *rest) in enumerate(self.stages(), 1)])

    def reports(self) -> dict[str, DataFrame]:
        """What each stage left, as tables."""
        points, geocoded = (self.spark.read.parquet(self.path(k)) for k in ("categorised", "geocoded"))
        aggregate = self.spark.read.parquet(self.path("aggregate"))
        return {
            "by_state": A.value_counts(points, "uf"),
            "by_brand": A.value_counts(points, "categoria_if", "sub_categoria"),
            "brand_by_state": A.crosstab(points, "sub_categoria", "uf", list(self.scope.states)),
            "unnamed": A.value_counts(points.where((F.col("sub_categoria") == tables.OTHER_COOPERATIVE) & (F.col("marca_exibicao") == tables.OTHER_COOPERATIVE)), "nome_instituicao"),
            "coverage_by_state": A.coverage_by(aggregate, "uf"),
            "coverage": A.coverage_summary(aggregate, points),
            "largest_unserved": A.top_k(aggregate.where("total_geral = 0"), "populacao", 10),
            "most_points": A.top_k(aggregate, "total_geral", 10),
            "precision": A.cumulative_levels(geocoded, "precisao", tables.PRECISION_LEVELS),
        }
