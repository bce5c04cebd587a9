"""The whole pipeline as one batch job: parse, window, detect, assemble, store."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, functions as F

from tickloom.operators.anomaly import anomaly_events, processed_ticks, zscore_anomaly
from tickloom.operators.quality import parse_canonical, parse_exchange, rejects, valid_ticks
from tickloom.operators.window import rolling_stats
from tickloom.params import AnomalyParams, WindowParams
from tickloom.session import materialise, passing_tables
from tickloom.sinks.table import stored_rows, write_batch, write_days

Sink = Callable[[DataFrame, int], None]
FORMS = {"exchange": parse_exchange, "canonical": parse_canonical}


def process(
    ticks: DataFrame, window: WindowParams | None = None, anomaly: AnomalyParams | None = None, *keep: str
) -> DataFrame:
    """PROCESSED rows from validated ticks."""
    return processed_ticks(zscore_anomaly(rolling_stats(ticks, window), anomaly), *keep)


def _nowhere(rows: DataFrame, batch_id: int) -> None:
    """A sink that is switched off."""


@dataclass(frozen=True)
class Sinks:
    """Where results go: each is any callable of (DataFrame, batch id)."""

    processed: Sink = _nowhere
    anomalies: Sink = _nowhere
    rejects: Sink = _nowhere


def table_sinks(folder: str) -> Sinks:
    """Day-partitioned ticks, anomaly events and rejected messages as Parquet under one folder."""
    return Sinks(
        processed=lambda rows, batch_id: write_days(stored_rows(rows), f"{folder}/processed_ticks", batch_id),
        anomalies=lambda rows, batch_id: write_batch(rows, f"{folder}/anomaly_events", batch_id),
        rejects=lambda rows, batch_id: write_batch(rows, f"{folder}/rejects", batch_id),
    )


SINKS_BY_NAME: dict[str, Callable[[str], Sinks]] = {"parquet": table_sinks}


def sinks_from_settings(settings: dict) -> Sinks:
    """Choose sinks by configuration: {"backend": name, "folder": path}."""
    backend = str(settings.get("backend", "parquet")).lower()
    if backend not in SINKS_BY_NAME:
        raise ValueError(f"backend must be one of {sorted(SINKS_BY_NAME)}, got {backend!r}")
    return SINKS_BY_NAME[backend](settings["folder"])


@dataclass(frozen=True)
class Job:
    """Parameters of one pipeline run."""

    form: str = "canonical"
    window: WindowParams = field(default_factory=WindowParams)
    anomaly: AnomalyParams = field(default_factory=AnomalyParams)

    def __post_init__(self) -> None:
        if self.form not in FORMS:
            raise ValueError(f"form must be one of {sorted(FORMS)}, got {self.form!r}")

    def parse(self, records: DataFrame) -> DataFrame:
        return FORMS[self.form](records)


def run_batch(records: DataFrame, sinks: Sinks, batch_id: int, job: Job | None = None) -> None:
    """Process ``records`` (``value``, ``seq``) once and write every output.

    Give each run its own ``batch_id``: running one again replaces what it wrote before.

    The parsed messages, and then the processed ticks, are written out before they are read more
    than once, so nothing is parsed or windowed twice. They are deleted at the end.
    """
    job = job or Job()
    with passing_tables(records.sparkSession):
        parsed = materialise(job.parse(records), "parsed")
        sinks.rejects(rejects(parsed), batch_id)
        processed = materialise(process(valid_ticks(parsed, "seq"), job.window, job.anomaly), "processed")
        sinks.processed(processed, batch_id)
        sinks.anomalies(anomaly_events(processed, job.anomaly), batch_id)
