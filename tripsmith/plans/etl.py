"""End-to-end plans: raw -> processed (Q1) and
processed -> labelled training frame (Q2).

Q1 is one application with four actions: the gate pass, the Parquet write (which counts
its rows), the count of what is read back, and the verification pass over the files.  Gate limits are
parameters (the reference's 100,000-row floor is the default).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame

from .. import config as C
from ..operators import clean as CL
from ..operators import gates as G
from ..operators.store import get_historical_features
from ..sources import sinks as SK


@dataclass
class EtlResult:
    gates: DataFrame
    verify: DataFrame
    manifest: DataFrame
    funnel: DataFrame
    handshake: DataFrame
    output_path: str
    size_mb: int


def run_etl(raw: DataFrame, output_path: str, raw_source: str, *, min_rows: int = C.MIN_ROW_COUNT,
            verify_min_rows: int = C.VERIFY_MIN_ROWS, fail: bool = True, run_id: str | None = None,
            execution_date: str | None = None, partition_by: tuple[str, ...] = ()) -> EtlResult:
    missing = G.missing_columns(raw)
    if missing:
        raise ValueError(f"missing columns: {missing}")
    gates = G.quality_gates(raw, min_rows=min_rows)
    if fail:
        G.raise_on_violation(gates)                      # action 1
    processed = CL.processed(raw, "full")
    rows, size = SK.write_counted(processed, output_path, partition_by)   # action 2
    shake = SK.handshake(raw.sparkSession, output_path, rows)
    if fail and not shake.first()["matches"]:
        raise ValueError(f"{output_path}: rows read back differ from the {rows} written")
    written = raw.sparkSession.read.parquet(output_path)
    verify = G.verify_output(written, min_rows=verify_min_rows)
    if fail:
        G.raise_on_violation(verify)                     # action 3
    man = SK.manifest(written, raw_source, output_path, size, run_id, execution_date)
    return EtlResult(gates, verify, man, CL.clean_funnel(raw), shake, output_path, size)


def training_frame(processed: DataFrame, feature_list=None):
    """Q2: point-in-time features, then the positional split as a column."""
    return get_historical_features(processed, feature_list)
