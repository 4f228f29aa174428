"""Parameters of every stage, as frozen dataclasses."""

from __future__ import annotations

from dataclasses import dataclass

# Names, defaults and cut-offs that results depend on.
PIPELINE_VERSION = "1.0.0"
TIME_COLUMN = "time_s"
SIGNAL_COLUMNS = (
    "plasma_current_MA",
    "electron_density",
    "electron_temperature",
    "loop_voltage",
)
QUALITY_FLAGS = ("OK", "DEGRADED", "REJECTED")
MAD_SCALE = 0.6745
MAD_EPSILON = 1e-9

# A series longer than 4 x SPLIT_ROWS is cut into time blocks of about SPLIT_ROWS
# rows, so that no task ever holds a whole hot series.
SPLIT_ROWS = 250_000
# Rows per block of an indexed series (grid or row number) in the cleaning steps.
GRID_BLOCK_ROWS = 16_384
# Largest table that is listed on the driver and broadcast; beyond it Spark joins by shuffle.
BROADCAST_ROWS = 100_000
BROADCAST_BYTES = 32 << 20
# Rows of one recording that go into one file of the mart, about 128 MB of five doubles.
FILE_ROWS = 4_000_000
# Directories that the fact table may have before recordings share them.
MAX_DIRECTORIES = 1000


@dataclass(frozen=True)
class CleaningConfig:
    target_sampling_hz: float = 1000
    outlier_mad_threshold: float = 6.0
    mad_window: int = 101
    max_gap_to_impute: int = 100
    signal_columns: tuple[str, ...] = SIGNAL_COLUMNS
    time_column: str = TIME_COLUMN
    ok_completeness: float = 0.98
    degraded_completeness: float = 0.90
    engine: str = "arrow"  # "arrow" (grouped map per block) or "sql" (window expressions)
    split_rows: int = SPLIT_ROWS
    block_rows: int = GRID_BLOCK_ROWS

    @property
    def halo_rows(self) -> int:
        """Rows a block must see on each side: two chained medians, then the longest fillable gap."""
        return 2 * (self.mad_window // 2) + self.max_gap_to_impute


@dataclass(frozen=True)
class FeatureConfig:
    plateau_fraction: float = 0.7
    drop_fraction: float = 0.5
    window_s: float = 0.05
    min_peak: float = 0.1
    min_rows: int = 10
    end_margin_s: float = 0.2
    split_rows: int = SPLIT_ROWS


@dataclass(frozen=True)
class MartConfig:
    output_dir: str = "data/processed"
    compression: str = "snappy"
    overwrite: bool = True
    file_rows: int = FILE_ROWS
    # One directory per recording is the contract; with very many short recordings a directory
    # may hold several, sorted by id, so that files keep a useful size.
    shots_per_directory: int = 1
    # Beyond this many recordings, one directory each would cost more than their rows: ranges of
    # ids share a directory then, and about this many are made.
    max_directories: int = MAX_DIRECTORIES
