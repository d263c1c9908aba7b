"""Engine parameters.

Every knob of the detector, the ETL and the reports lives in one frozen
dataclass so a job (batch or streaming) is a pure function of
``(DataFrame, RuleConfig)``.
"""

from __future__ import annotations

from dataclasses import dataclass, field

# ---------------------------------------------------------------------------
# These must equal the behaviour being reproduced.
#   high-value threshold 5000.0, strict ">" comparison
#   travel window 10 minutes, sliding every 5 minutes
#   watermark delay 2 minutes on event time
#   a window is guilty when it holds more than 1 distinct country
#   reconciliation passes when the difference is below 0.02
#   the top-accounts report shows 10 accounts
#   fraud type labels: HIGH_VALUE, IMPOSSIBLE_TRAVEL
#   reconciliation status labels: PASS, FAIL
#   default currency: USD
#   money at rest: NUMERIC(14,2) per row
# ---------------------------------------------------------------------------
HIGH_VALUE = "HIGH_VALUE"
IMPOSSIBLE_TRAVEL = "IMPOSSIBLE_TRAVEL"
STATUS_PASS = "PASS"
STATUS_FAIL = "FAIL"
DEFAULT_CURRENCY = "USD"
AMOUNT_TYPE = "decimal(14,2)"
# Run totals widen NUMERIC(18,2) to 38 digits: 18 overflows near 1e16,
# which a 100 TB ingest can reach.
TOTAL_TYPE = "decimal(38,2)"


@dataclass(frozen=True)
class RuleConfig:
    high_value_threshold: float = 5000.0
    travel_window: str = "10 minutes"
    # None = tumbling window; the executed default slides every 5 minutes.
    travel_slide: str | None = "5 minutes"
    watermark_delay: str | None = "2 minutes"
    min_countries: int = 2
    reconcile_tolerance: str = "0.02"
    top_accounts: int = 10
    # Extra partition columns of the per-run warehouse snapshot (e.g.
    # ("country",)); the snapshot is always one folder per run.
    snapshot_partition_by: tuple[str, ...] = ()
    # The ETL reads only what is new since the last run where that gives a full
    # run's totals; a snapshot is at most this many layers (runs) deep.
    etl_incremental: bool = True
    snapshot_layers: int = 16
    # Streaming knobs (the alert query always runs in append mode: a window
    # is reported once, after the watermark has closed it).
    # Join partitions per (window, account) in the streaming travel join;
    # part of the checkpointed plan, so fixed once a query has started.
    travel_salt_buckets: int = 8
    # State partitions of every stateful streaming operator; fixed in the
    # checkpoint at first start.  None = the cluster's default parallelism.
    state_partitions: int | None = None
    # Duplicate wire events: False keeps them as data for the rules (like
    # the reference); True drops copies arriving within the watermark delay.
    dedupe_within_watermark: bool = False
    # all_transactions key check in the stream: "global" remembers every
    # key (exact primary key, state grows with the key count); "watermark"
    # remembers keys for the watermark delay only (bounded state).
    txn_dedupe: str = "global"
    starting_offsets: str = "latest"
    # The moment "latest" stands for, resolved once for all queries of a job.
    start_timestamp_ms: int | None = None
    fail_on_data_loss: bool = False
    kafka_bootstrap: str = "localhost:9092"
    kafka_topic: str = "bank_transactions"
    extra_kafka_options: dict = field(default_factory=dict)

    def tumbling(self) -> "RuleConfig":
        """Same rules with a tumbling travel window (slide == width)."""
        from dataclasses import replace

        return replace(self, travel_slide=None)


DEFAULT = RuleConfig()
