"""Feature switches and their defaults, inputs and outputs of a transform."""

from __future__ import annotations

from dataclasses import dataclass, field

TIERS = ("bronze", "silver", "gold")
CATEGORIES = ("structural", "rolling", "dynamic", "advanced", "bars")
MODES = ("append", "overwrite", "overwrite_partition", "merge")
FORMATS = ("parquet", "ndjson", "json", "csv")


@dataclass(frozen=True)
class Features:
    categories: tuple[str, ...] = ("structural", "dynamic")
    depth_levels: int = 20
    ofi_levels: int = 10
    bands_bps: tuple[int, ...] = (5, 10, 25, 50, 100)
    rolling_windows: tuple[int, ...] = (5, 15, 60, 300, 900)
    bar_durations: tuple[int, ...] = (60, 300, 900, 3600)
    ofi_decay_alpha: float = 0.5
    kyle_lambda_window: int = 300
    enable_vpin: bool = True
    vpin_bucket: float = 1.0
    vpin_window: int = 50
    spread_regime_window: int = 300
    spread_tight: float = 0.2
    spread_wide: float = 0.8
    resample_frequency: str | None = None
    max_staleness: str | None = None
    drop_raw_book_arrays: bool = True
    normalize_quotes: bool = True
    max_gap_seconds: int = 300

    def __post_init__(self):
        if unknown := set(self.categories) - set(CATEGORIES):
            raise ValueError(f"unknown categories: {sorted(unknown)}")

    def has(self, category: str) -> bool:
        return category in self.categories


@dataclass
class Input:
    name: str
    path: str = ""
    format: str = "parquet"
    schema: str | None = None
    columns: list[str] | None = None
    filters: list[tuple] = field(default_factory=list)

    def validate(self) -> None:
        if not self.name or self.format not in FORMATS:
            raise ValueError(f"bad input: {self.name!r} {self.format!r}")


@dataclass
class Output:
    name: str
    path: str = ""
    mode: str = "append"
    partition_by: list[str] = field(default_factory=lambda: ["exchange", "symbol", "year", "month", "day"])
    keys: list[str] = field(default_factory=list)

    def validate(self) -> None:
        if not self.name or self.mode not in MODES:
            raise ValueError(f"bad output: {self.name!r} {self.mode!r}")
        if self.mode == "merge" and not self.keys:
            raise ValueError("merge needs keys")


@dataclass
class Config:
    name: str
    inputs: list[Input] = field(default_factory=list)
    outputs: list[Output] = field(default_factory=list)
    features: Features = Features()

    def validate(self) -> None:
        if not self.name or not self.inputs or not self.outputs:
            raise ValueError("a transform needs a name, inputs and outputs")
        for x in (*self.inputs, *self.outputs):
            x.validate()
