"""Warehouse tables: columns, keys and comments.

Fixed values: the names of tables and columns, their types and their constraints.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


@dataclass(frozen=True)
class ForeignKey:
    columns: tuple[str, ...]
    parent: str
    parent_columns: tuple[str, ...]


@dataclass(frozen=True)
class Table:
    """A table's columns and the constraints that ``operators.quality`` checks."""

    name: str
    columns: str
    primary_key: tuple[str, ...] = ()
    unique: tuple[tuple[str, ...], ...] = ()
    not_null: tuple[str, ...] = ()
    foreign_keys: tuple[ForeignKey, ...] = ()
    comment: str = ""
    column_comments: dict[str, str] = field(default_factory=dict)

    @property
    def schema(self) -> T.StructType:
        return T._parse_datatype_string(self.columns)

    @property
    def column_names(self) -> list[str]:
        return [part.split()[0] for part in self.columns.split(",")]

    def conform(self, df: DataFrame) -> DataFrame:
        """Select this table's columns by name, in order, with their types and comments."""
        types = dict(part.split() for part in self.columns.split(","))
        return df.select(
            *[
                F.col(name)
                .cast(types[name])
                .alias(name, metadata={"comment": self.column_comments.get(name, "")})
                for name in self.column_names
            ]
        )


def _fk(columns: str, parent: str, parent_columns: str | None = None) -> ForeignKey:
    return ForeignKey(tuple(columns.split()), parent, tuple((parent_columns or columns).split()))


CATALOGUE_SOURCE: Sequence[str] = (
    "Size", "Vintage", "Wine", "Locale", "Country", "Region", "SubRegion",
    "Appellation", "Producer", "Type", "Color", "Category", "Varietal",
)

REGISTER_SOURCE = (
    "detection string, sampler string, samplecode string, vintage string, name string, "
    "open_date string, sampled_date string, added_to_cellartracker string, notes string, size string"
)

RUN_METADATA_SOURCE = (
    "notebook string, date string, method string, injection_volume string, seq_name string, "
    "seq_desc string, vialnum string, originalfilepath string, id string, desc string"
)

_CT = (
    "wine_key string,size string,vintage int,wine string,locale string,country string,"
    "region string,subregion string,appellation string,producer string,type string,"
    "color string,category string,varietal string"
)

TABLES: dict[str, Table] = {
    t.name: t
    for t in (
        Table(
            "ct", _CT,
            primary_key=("wine", "vintage"),
            unique=(("wine_key",),),
            not_null=tuple(part.split()[0] for part in _CT.split(",")),
            comment="Catalogue of products, one row per name and vintage.",
        ),
        Table(
            "st",
            "detection string,wine string,vintage int,sampler string,samplecode string,"
            "open_date string,sampled_date string,added_to_cellartracker boolean,"
            "notes string,size float",
            primary_key=("samplecode",),
            not_null=("detection",),
            foreign_keys=(_fk("wine vintage", "ct"),),
            comment="Register of samples that have a catalogue row.",
        ),
        Table(
            "chm_loading",
            "ch_runid string,samplecode string,acq_date timestamp_ntz,acq_method string,"
            "inj_vol float,seq_name string,seq_desc string,vialnum string,"
            "originalfilepath string,id string,description string,path string",
            primary_key=("ch_runid",),
            unique=(("samplecode",), ("acq_date",), ("id",)),
            not_null=("acq_date", "acq_method", "inj_vol", "seq_name", "id"),
        ),
        Table(
            "sequences", "seq_name string,dt_run timestamp_ntz,seq_desc string",
            primary_key=("seq_name",),
            unique=(("dt_run",),),
            comment="Sequences of runs and the time each was started.",
        ),
        Table(
            "chm",
            "runid string,samplecode string,acq_date timestamp_ntz,acq_method string,"
            "inj_vol float,seq_name string,vialnum string,originalfilepath string,"
            "id string,description string,path string",
            primary_key=("runid",),
            unique=(("acq_date",), ("id",)),
            not_null=("samplecode", "acq_method", "inj_vol", "vialnum", "originalfilepath", "id"),
            foreign_keys=(_fk("samplecode", "st"), _fk("seq_name", "sequences")),
            comment="Runs that have a register row.",
        ),
        Table(
            "solvcomps",
            "runid string,channel string,ch1_solv string,name_1 string,ch2_solv string,"
            "name_2 string,selected string,used string,percent float",
            primary_key=("runid", "channel"),
            not_null=("channel", "ch1_solv", "selected", "used", "percent"),
            foreign_keys=(_fk("runid", "chm"),),
            comment="Solvent composition at the start of each run, one row per channel.",
        ),
        Table(
            "timetables",
            "runid string,idx int,mins float,a float,b float,flow float,pressure float",
            primary_key=("runid", "idx"),
            not_null=("idx", "mins", "a", "b", "flow", "pressure"),
            foreign_keys=(_fk("runid", "chm"),),
            comment="Elution program of each run, one row per step.",
        ),
        Table(
            "bin_pump_mech_params", "runid string,flow float,pressure float",
            primary_key=("runid",),
            foreign_keys=(_fk("runid", "chm"),),
        ),
        Table(
            "channels", "runid string,mins double,channel string,percent double",
            primary_key=("runid", "mins", "channel"),
            foreign_keys=(_fk("runid", "chm"),),
        ),
        Table(
            "solvents", "runid string,a string,b string",
            primary_key=("runid",),
            foreign_keys=(_fk("runid", "chm"),),
        ),
        Table(
            "solvprop_over_mins", "runid string,mins double,channel string,percent double",
            primary_key=("runid", "mins", "channel"),
            foreign_keys=(_fk("runid", "chm"),),
        ),
        Table(
            "image_stats",
            "runid string,nm_min int,nm_max int,nm_count int,mins_min float,mins_max float,"
            "mins_count int,abs_min float,abs_max float,abs_argmin bigint,abs_argmax bigint,"
            "hertz float,path string",
            primary_key=("runid",),
            unique=(("path",),),
            not_null=(
                "nm_min", "nm_max", "nm_count", "mins_min", "mins_max", "mins_count", "abs_min",
                "abs_max", "abs_argmin", "abs_argmax", "hertz", "path",
            ),
            column_comments={"nm_count": "all columns of the image, id and mins included"},
        ),
        Table(
            "excluded", "runid string,reason string",
            primary_key=("runid",),
            not_null=("reason",),
            foreign_keys=(_fk("runid", "chm"),),
            comment="Runs kept out of analyses, and why.",
        ),
    )
}
