"""Parameters of the analytics jobs, one frozen dataclass per concern."""

from __future__ import annotations

from dataclasses import dataclass, field


@dataclass(frozen=True)
class StreamParams:
    topic: str = "orders"
    bootstrap_servers: str = "localhost:9092"
    starting_offsets: str = "latest"
    # Upper bound of one micro-batch, for catching up; None takes all there is.
    max_offsets_per_trigger: int | None = None
    trigger: str = "10 seconds"
    watermark: str = "10 minutes"
    window: str = "1 minute"
    # After so many batches the files of all tables are gathered.
    compact_every: int = 64


@dataclass(frozen=True)
class AnomalyParams:
    # Fixed values of the spike detectors.
    method: str = "isolation_forest"
    zscore_minutes: int = 30
    forest_minutes: int = 24 * 60
    zscore_min_rows: int = 5
    forest_min_rows: int = 15
    z_high: float = 3.0
    z_critical: float = 5.0
    trees: int = 150
    contamination: float = 0.05
    seed: int = 42
    subsample: int = 256
    critical_score: float = -0.2


@dataclass(frozen=True)
class CooldownParams:
    # Minutes during which a repeated alert is held back.
    low_stock: int = 10
    kpi: int = 5
    spike: int = 30


@dataclass(frozen=True)
class CatalogParams:
    # Value written to, and expected in, the `source` column of the catalog.
    source_name: str = "catalog_api"


@dataclass(frozen=True)
class JdbcParams:
    url: str = ""
    user: str = ""
    password: str = ""
    driver: str = "com.mysql.cj.jdbc.Driver"
    batch_size: int = 500


@dataclass(frozen=True)
class Params:
    stream: StreamParams = field(default_factory=StreamParams)
    anomaly: AnomalyParams = field(default_factory=AnomalyParams)
    cooldown: CooldownParams = field(default_factory=CooldownParams)
    catalog: CatalogParams = field(default_factory=CatalogParams)


DEFAULTS = Params()
