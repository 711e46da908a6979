"""Typed arguments of the jobs."""

from __future__ import annotations

import re
from dataclasses import dataclass, field
from datetime import date, datetime
from zoneinfo import ZoneInfo

from pyspark.sql import types as T

from stratalake import schemas
from stratalake.errors import BadInput

LOAD_ZONE = "America/Sao_Paulo"
"""Time zone in which a load date is taken."""

WRITE_MODES = ("append", "replace_slice", "overwrite_table")


def today_load_date(zone: str = LOAD_ZONE) -> str:
    """Today's load date in the lake's time zone."""
    return datetime.now(ZoneInfo(zone)).strftime("%Y%m%d")


def load_day(load_date: str) -> date:
    """The calendar day of a load date; raises when it is not ``yyyyMMdd``."""
    if not re.fullmatch(r"\d{8}", load_date):
        raise BadInput(f"load date must be yyyyMMdd text, got {load_date!r}")
    return datetime.strptime(load_date, "%Y%m%d").date()


@dataclass(frozen=True)
class Lake:
    """Where the lake lives, and the limits its jobs plan with.

    ``rows_per_task`` is how many rows of one join key a single task may take before the key is
    salted. ``broadcast_chars`` bounds the text of a table that may be broadcast. Files are cut at
    ``target_file_bytes``, where a byte of a compressed file holds ``chars_per_byte`` of text.
    """

    root: str
    stage_root: str
    database_prefix: str = ""
    rows_per_task: int = 2_000_000
    broadcast_chars: int = 64 * 1024 * 1024
    target_file_bytes: int = 128 * 1024 * 1024
    chars_per_byte: float = 4.0

    def rows_per_file(self, row_chars: float) -> int:
        """Rows of that mean text length that fill a file of the target size."""
        return max(1, int(self.target_file_bytes * self.chars_per_byte / max(row_chars, 1)))

    def database(self, name: str) -> str:
        return f"{self.database_prefix}{name}"


@dataclass(frozen=True)
class LakeTable:
    """A lake table: ``schema`` ends with the partition columns."""

    database: str
    name: str
    schema: T.StructType
    partition_by: tuple[str, ...] = (schemas.LOAD_DATE,)

    def full_name(self, lake: Lake) -> str:
        return f"{lake.database(self.database)}.{self.name}"

    def path(self, lake: Lake) -> str:
        return f"{lake.root}/{lake.database(self.database)}/{self.name}"


@dataclass(frozen=True)
class BronzeLoad:
    """How the dated files of one source become a bronze table.

    ``refuse_ragged`` fails a load with records of more or fewer values than their header; without it
    they are counted and logged. ``bad_rows`` says what becomes of those, and of rows with a null in a required column:
    ``"fail"`` fails the load, ``"quarantine"`` writes them to a table of rejects beside the good ones.
    ``verify`` is what a load is reconciled by before its files may be purged: the ``"content"`` of the slice, read back, or
    only the number of its ``"rows"``.
    """

    table: LakeTable
    required: tuple[str, ...]
    file_type: str = "csv"
    sep: str = ","
    mode: str = "replace_slice"
    null_markers: tuple[str, ...] = ("NULL", "null")
    multiline: bool = False
    reject_empty: bool = False
    refuse_ragged: bool = True
    bad_rows: str = "fail"
    verify: str = "content"
    read_options: dict[str, str] = field(default_factory=dict)


def rejects_of(table: LakeTable) -> LakeTable:
    """The table of the rows that a table's loads refused."""
    return LakeTable(table.database, f"{table.name}_rejeitos", schemas.REJECTS)


CUSTOMERS = LakeTable("b_cad", "clientes", schemas.CUSTOMERS)
PRODUCTS = LakeTable("b_cad", "produtos", schemas.PRODUCTS)
ACQUISITIONS = LakeTable("b_vend", "clientesxprod", schemas.ACQUISITIONS)
CREDIT_CUSTOMERS = LakeTable("s_vend", "clie_limit", schemas.CREDIT_CUSTOMERS)
PRODUCT_TOTALS = LakeTable("g_vend", "prod_contrat_diario", schemas.PRODUCT_TOTALS)

ALL_TABLES = (CUSTOMERS, PRODUCTS, ACQUISITIONS, CREDIT_CUSTOMERS, PRODUCT_TOTALS)
DATABASES = ("b_cad", "b_vend", "s_vend", "g_vend")

# The columns each source must fill.
BRONZE_LOADS = {
    "clientes": BronzeLoad(CUSTOMERS, ("nome", "cpf")),
    "produtos": BronzeLoad(PRODUCTS, ("produto_id", "nome", "descricao", "categoria")),
    "clientesxprod": BronzeLoad(ACQUISITIONS, ("cliente_id", "produto_id")),
}
