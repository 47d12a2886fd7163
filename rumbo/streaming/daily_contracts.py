"""Daily contract load over newly arrived contract files.

``start_contract_load`` reads the contract folder as a file stream; every
micro-batch holds only files not seen before (tracked in the checkpoint
folder) and runs the same contract-core plan as the batch load, with the
catalogue and dictionary read as static tables.  Each micro-batch overwrites
its own ``batch=<epoch>`` folder, and the checkpoint records which files were
consumed, so a batch replayed after a failure replaces its output instead of
duplicating it.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from ..plans import core


class _WithContracts:
    """A sources view whose ``contracts`` table is one micro-batch."""

    def __init__(self, base, contracts: DataFrame):
        self._base, self.contracts = base, contracts

    def __getattr__(self, name):
        return getattr(self._base, name)


def start_contract_load(spark: SparkSession, contracts_dir: str, src, as_of: _dt.date, since: _dt.date,
                        sink_dir: str, checkpoint_dir: str, schema=None) -> StreamingQuery:
    """Process every contract file not yet seen, then stop (``availableNow``)."""
    stream = spark.readStream.schema(schema or src.contracts.schema).parquet(contracts_dir)

    def run_batch(batch: DataFrame, epoch_id: int) -> None:
        out = core.contract_core(_WithContracts(src, batch), as_of, since)
        out.write.mode("overwrite").parquet(f"{sink_dir}/batch={epoch_id}")

    return (stream.writeStream.foreachBatch(run_batch)
            .option("checkpointLocation", checkpoint_dir)
            .trigger(availableNow=True).start())
