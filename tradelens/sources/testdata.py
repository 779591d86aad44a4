"""Trade-shaped fact rows over the TPC-H-style test tables.

Exports (FLOW "E"): reporter = supplier's nation, partner = customer's
nation, period of the ship date. Imports (FLOW "I"): the mirror view,
reporter = customer's nation, partner = supplier's nation, one month later,
returned line items ('R') left out. COMMODITY = "31" + two digits of
(partkey mod 6) + 1, so 3101..3106.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schema import COMMODITY, FLOW, MONTH, PARTNER, QTY1, REPORTER, VALUE, YEAR


def _read(spark: SparkSession, sf_dir: str, name: str, *cols: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet").select(*cols)


def trade_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both flows at (FLOW, REPORTER, PARTNER, COMMODITY, YEAR, MONTH) grain.

    One join pass and one aggregation serve both flows: the line items are
    aggregated once at (supplier nation, customer nation, commodity, month)
    with the non-returned part as extra sums, then each aggregate row is
    emitted as its export row and, if any item was kept, its import row.
    """
    li = _read(spark, sf_dir, "lineitem", "l_orderkey", "l_partkey", "l_suppkey",
               "l_quantity", "l_extendedprice", "l_returnflag", "l_shipdate")
    orders = _read(spark, sf_dir, "orders", "o_orderkey", "o_custkey")
    nation = _read(spark, sf_dir, "nation", "n_nationkey", "n_name")
    cust = (_read(spark, sf_dir, "customer", "c_custkey", "c_nationkey")
            .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
            .select("c_custkey", F.col("n_name").alias("CUST_NATION")))
    # Orders get the customer's nation before meeting the line items, so the
    # line items are shuffled twice (order key, supplier key), not three times.
    order_nation = (orders.join(cust, F.col("o_custkey") == F.col("c_custkey"))
                    .select("o_orderkey", "CUST_NATION"))
    supp = (_read(spark, sf_dir, "supplier", "s_suppkey", "s_nationkey")
            .join(nation, F.col("s_nationkey") == F.col("n_nationkey"))
            .select("s_suppkey", F.col("n_name").alias("SUPP_NATION")))

    joined = (li.join(order_nation, F.col("l_orderkey") == F.col("o_orderkey"))
              .join(supp, F.col("l_suppkey") == F.col("s_suppkey")))
    kept = F.col("l_returnflag") != "R"
    pre = (joined
           .withColumns({
               COMMODITY: F.concat(F.lit("31"), F.lpad((F.col("l_partkey") % 6 + 1).cast("string"), 2, "0")),
               "Y": F.year("l_shipdate").cast("int"),
               "M": F.month("l_shipdate").cast("int"),
           })
           .groupBy("SUPP_NATION", "CUST_NATION", COMMODITY, "Y", "M")
           .agg(F.sum("l_quantity").alias("Q_ALL"),
                F.sum("l_extendedprice").alias("V_ALL"),
                F.sum(F.when(kept, F.col("l_quantity"))).alias("Q_KEEP"),
                F.sum(F.when(kept, F.col("l_extendedprice"))).alias("V_KEEP"),
                F.count(F.when(kept, F.lit(1))).alias("N_KEEP")))

    def row(flow, rep, par, y, m, q, v):
        return F.struct(F.lit(flow).alias(FLOW), F.col(rep).alias(REPORTER), F.col(par).alias(PARTNER),
                        F.col(COMMODITY).alias(COMMODITY), y.cast("int").alias(YEAR),
                        m.cast("int").alias(MONTH), F.col(q).cast("double").alias(QTY1),
                        F.col(v).cast("double").alias(VALUE))

    exp = row("E", "SUPP_NATION", "CUST_NATION", F.col("Y"), F.col("M"), "Q_ALL", "V_ALL")
    imp = F.when(F.col("N_KEEP") > 0, row(
        "I", "CUST_NATION", "SUPP_NATION",
        F.col("Y") + F.when(F.col("M") == 12, 1).otherwise(0), F.col("M") % 12 + 1, "Q_KEEP", "V_KEEP"))
    return (pre.select(F.explode(F.array(exp, imp)).alias("r"))
            .where(F.col("r").isNotNull()).select("r.*"))
