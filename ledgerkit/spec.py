"""Declarations a job is built from: file dialect, typed columns, tables, parent link, run settings."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field, replace

# The file dialect, formats and sizes whose results must match.
DELIMITER = ";"
QUOTE = '"'
ESCAPE = '"'
ENCODING = "UTF-8"
DATE_FORMAT = "d/MM/yyyy"
TIME_SUFFIX = r" \d+:\d+:\d+$"
MAX_RECORDS_PER_FILE = 100_000


@dataclass(frozen=True)
class Dialect:
    """How a delimited file is written.

    ``multiline=False`` is valid only for files without newlines inside quotes; Spark can then split
    one file over many tasks. ``split=True`` does the same for well-quoted multi-line files (see
    ``sources.split_scan``).
    """

    delimiter: str = DELIMITER
    quote: str = QUOTE
    escape: str = ESCAPE
    encoding: str = ENCODING
    header: bool = True
    multiline: bool = True
    trim: bool = True
    mode: str = "PERMISSIVE"
    split: bool = False
    split_bytes: int | None = None  # size of a split; the session's own setting by default

    def parse_options(self) -> dict[str, str]:
        """Options shared by the file reader and ``from_csv``."""
        trim = str(self.trim).lower()
        return {
            "delimiter": self.delimiter,
            "quote": self.quote,
            "escape": self.escape,
            "ignoreLeadingWhiteSpace": trim,
            "ignoreTrailingWhiteSpace": trim,
            "mode": self.mode,
        }

    def read_options(self) -> dict[str, str]:
        return self.parse_options() | {
            "header": str(self.header).lower(),
            "multiLine": str(self.multiline).lower(),
            "encoding": self.encoding,
        }

    def write_options(self) -> dict[str, str]:
        return {
            "delimiter": self.delimiter,
            "quote": self.quote,
            "escape": self.escape,
            "encoding": self.encoding,
            "header": str(self.header).lower(),
            "ignoreLeadingWhiteSpace": "false",
            "ignoreTrailingWhiteSpace": "false",
        }


@dataclass(frozen=True)
class ColumnSpec:
    """One typed output column.

    ``kind`` is ``text``, ``long``, ``double``, ``date`` or ``decimal(p,s)``. ``decimal_comma`` turns
    commas into dots before a numeric parse; ``grouping`` names a thousands separator to drop first.
    """

    name: str
    kind: str = "text"
    source: str | None = None
    decimal_comma: bool = False
    grouping: str | None = None
    date_format: str = DATE_FORMAT

    @property
    def source_name(self) -> str:
        return self.source or self.name


@dataclass(frozen=True)
class Roles:
    """What a table's columns mean to the reports; a role without a column leaves its report out.

    ``date``: counted by year, its range and raw layouts reported. ``category``: its most frequent values.
    ``distinct``: columns whose values are counted, by output name. ``quantity`` is added up, ``rate`` averaged, ``start``
    and ``end`` span a period. ``watched``: nulls here are values lost in parsing or linking.
    """

    date: str | None = None
    category: str | None = None
    distinct: Mapping[str, str] = field(default_factory=dict)
    quantity: str | None = None
    rate: str | None = None
    start: str | None = None
    end: str | None = None
    watched: tuple[str, ...] = ()
    sample: tuple[str, ...] = ()


@dataclass(frozen=True)
class TableSpec:
    name: str
    columns: tuple[ColumnSpec, ...]
    key: str
    required: tuple[str, ...] = ()
    roles: Roles = field(default_factory=Roles)

    @property
    def column_names(self) -> list[str]:
        return [c.name for c in self.columns]

    def source_of(self, column: str) -> str:
        """The raw column a typed one comes from."""
        return next((c.source_name for c in self.columns if c.name == column), column)

    def replacing(self, old: str, new: ColumnSpec) -> TableSpec:
        """The same table with one column exchanged, e.g. the parent key for its alternate key."""
        columns = tuple(new if c.name == old else c for c in self.columns)
        return replace(self, columns=columns)


@dataclass(frozen=True)
class ParentLink:
    """How child rows find their parent: the key itself, or an alternate key looked up in the parent."""

    key: str
    alternate: str


@dataclass(frozen=True)
class JobConfig:
    """Everything one run needs; nothing is read from the environment or the session conf.

    ``location`` puts the written tables under that folder instead of the catalog's warehouse.
    ``repair`` is the header rule (``strict`` or ``legacy``), ``on_duplicate`` the alternate-key rule
    (``fan_out``, ``min`` or ``error``). Files are read by many tasks each unless ``dialect`` says otherwise;
    ``rebalance`` spreads the rows of files read whole right after the scan, where few files hold most of the bytes. A
    large load should raise ``max_records_per_file``, or it writes very many files. Beside the two tables a run writes the
    records that do not fit their file's header, as ``<table>_rejects``, and the profile of the raw text, as
    ``<parents_table>_raw_profile``.
    """

    parents_path: str
    children_path: str
    parents_table: str
    children_table: str
    parents: TableSpec
    children: TableSpec
    link: ParentLink
    dialect: Dialect = field(default_factory=lambda: Dialect(split=True))
    rebalance: bool = False
    repair: str = "strict"
    on_duplicate: str = "fan_out"
    max_records_per_file: int = MAX_RECORDS_PER_FILE
    location: str | None = None
    table_format: str = "parquet"
