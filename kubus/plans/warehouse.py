"""Build a warehouse: dimensions, fact and rejects as Parquet tables.

``build_warehouse`` is the ETL run: flattened dimensions and the calendar are
written as small tables; the sales text is parsed and classified in one pass
and written once, partitioned by year with the rejects in a partition of
their own.  The lines are shuffled once, to their article, whose partitions
AQE coalesces by size and splits where an article is hot; they are written
from there.  A year has at most a file of each such partition, so the number
of files follows the size of a load, not the number of tasks that read it.
Every table is overwritten, so a re-run gives the same content.

``load_period`` brings a batch into a warehouse that exists: the years the
batch is for are replaced, and so are the rejects of an earlier run of the
same batch; all other files stay.  ``append_dimension`` adds the members that
a written dimension lacks.  Both give the same content when repeated.

The counts of a load come from the rows as they are written
(``DataFrame.observe``), not from another pass.
"""

from __future__ import annotations

import os
import uuid
from dataclasses import dataclass, field

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..operators import dims as D
from ..operators import facts as FT

SALES_TABLE = "sales"
FULL_LOAD = 0  # the number of the first load; rejects lie in the partition of minus the load's number
# An empty load writes no file to read the schema from.
SALES_SCHEMA = ("Date string, Shop string, Article string, Sold string, Revenue string, "
                "source_file string, source_line bigint, "
                "sale_date date, sale_date_key int, shop_key bigint, product_key bigint, "
                "sold_quantity int, sale_revenue decimal(10,2), reject_reason string, "
                "sale_year int")
OTHER_PERIOD = "other_period"  # a valid line of a year the batch is not for


@dataclass(frozen=True)
class LoadReport:
    """What a load wrote: accepted lines and rejected ones by reason."""

    accepted: int = 0
    rejected: dict[str, int] = field(default_factory=dict)

    @property
    def total(self) -> int:
        return self.accepted + sum(self.rejected.values())

    def frame(self, spark: SparkSession) -> DataFrame:
        """(outcome, rows): ``accepted`` and every reason met."""
        return spark.createDataFrame([("accepted", self.accepted), *self.rejected.items()],
                                     "outcome string, rows bigint")


def write_classified(classified: DataFrame, path: str, batch: int = FULL_LOAD,
                     replace_all: bool = True) -> LoadReport:
    """Write classified lines, each task one file of a partition that it has
    rows of; with ``replace_all=False`` only the partitions that get rows are
    replaced."""
    for name, kind in (("source_file", "string"), ("source_line", "bigint")):
        if name not in classified.columns:
            classified = classified.withColumn(name, F.lit(None).cast(kind))
    ok = F.col("reject_reason").isNull()
    rows = classified.withColumn("sale_year", F.when(
        ok, F.expr("CAST(sale_date_key DIV 10000 AS INT)")).otherwise(F.lit(-batch)))
    # Observed in the tasks that write: a map stage that is run again after a
    # lost executor would be counted twice.
    seen = Observation(f"load-{uuid.uuid4().hex}")
    reasons = (*FT.REASONS, OTHER_PERIOD)
    rows = rows.sortWithinPartitions("sale_year", "sale_date_key") \
        .observe(seen, F.count_if(ok).alias("accepted"),
                 *[F.count_if(F.col("reject_reason") == r).alias(r) for r in reasons])
    (rows.write.mode("overwrite").option("compression", "zstd").partitionBy("sale_year")
     .option("partitionOverwriteMode", "static" if replace_all else "dynamic").parquet(path))
    counts = seen.get
    return LoadReport(counts["accepted"], {r: counts[r] for r in reasons if counts[r]})


DIMENSIONS = ("dim_date", "dim_shop", "dim_product")


def _classified(spark: SparkSession, out: str, sales_text: DataFrame) -> DataFrame:
    """Classify against the written dimensions, so the fact and its lookups
    agree even if the inputs change underneath."""
    dims = {n: spark.read.parquet(os.path.join(out, n)) for n in DIMENSIONS}
    return FT.classify_sales(sales_text, dims["dim_shop"], dims["dim_product"], dims["dim_date"], deal=True)


def build_warehouse(out: str, dim_date: DataFrame, dim_shop: DataFrame,
                    dim_product: DataFrame, sales_text: DataFrame) -> LoadReport:
    """Write dim_date, dim_shop, dim_product and the classified sales under
    ``out``; ``WarehouseStar`` reads them."""
    for name, df in zip(DIMENSIONS, (dim_date, dim_shop, dim_product)):
        df.write.mode("overwrite").parquet(os.path.join(out, name))
    return write_classified(_classified(sales_text.sparkSession, out, sales_text),
                            os.path.join(out, SALES_TABLE))


def load_period(out: str, sales_text: DataFrame, years: list[int], batch: int) -> LoadReport:
    """Load a batch of ``years`` into a warehouse that exists.

    The fact rows of these years that get new ones are replaced, and the
    rejects of an earlier load under the same ``batch`` number (from 1).  A valid line of
    another year is rejected as ``other_period``: a stray line must not replace
    a year.  A year or batch without any new row keeps its old ones.
    """
    if not years or batch <= FULL_LOAD:
        raise ValueError("name the batch's years and number it from 1")
    classified = _classified(sales_text.sparkSession, out, sales_text)
    other = F.col("reject_reason").isNull() & ~F.expr("sale_date_key DIV 10000").isin(*years)
    classified = classified.withColumn("reject_reason", F.when(other, OTHER_PERIOD)
                                       .otherwise(F.col("reject_reason")))
    return write_classified(classified, os.path.join(out, SALES_TABLE), batch, replace_all=False)


def append_dimension(new: DataFrame, path: str, key: str | list[str]) -> None:
    """Append the rows of ``new`` whose key the table at ``path`` lacks; a
    table that does not exist is created.  Of rows that share a key one stays;
    null is a key like others.  Running it again adds nothing."""
    keys = [key] if isinstance(key, str) else list(key)
    try:
        known = new.sparkSession.read.parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        known = new.limit(0)
    absent = D.insert_if_absent(new, known, keys)
    absent.write.mode("append").parquet(path)
