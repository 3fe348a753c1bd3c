"""Role-played joins over the warehouse star (D4-D7) and the constraint checks.

Dimensions join the fact by key; a dimension used in two roles (order date / ship date,
shipping location / customer home location) is joined twice under different names. The
date dimension and location dimension are bounded by the calendar and by geography, so the
planner's size estimate (or AQE at runtime) broadcasts them; no hint is forced here.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import schemas
from ..operators.quality import check_star
from .star import SourceStar
from .warehouse import location_ids, two_batch_run


def q_loc_lookup_nullsafe(star: SourceStar) -> DataFrame:
    """Every staged customer of both batches -> location id, NULL parts matching."""
    s1, s2 = two_batch_run(star, whole=True)
    cust = s1.staging["stg_dim_customer"].unionByName(s2.staging["stg_dim_customer"])
    return location_ids(cust, s2.tables["dim_location"]).select("customer_key", "postal_code", "location_id")


def q_date_roles(star: SourceStar) -> DataFrame:
    """Each order with its order date and ship date (two roles of dim_date)."""
    t = two_batch_run(star, whole=True)[1].tables
    d = t["dim_date"]
    od = d.select(F.col("date_id").alias("order_date_id"), F.col("full_date").alias("order_date"))
    sd = d.select(F.col("date_id").alias("ship_date_id"), F.col("full_date").alias("ship_date"))
    return (t["dim_order"].join(od, "order_date_id").join(sd, "ship_date_id")
            .select("order_key", "order_date", "ship_date",
                    F.datediff("ship_date", "order_date").cast("long").alias("days_to_ship")))


def q_same_day_orders(star: SourceStar) -> DataFrame:
    """The conjunctive relation order_date_id = date_id AND ship_date_id = date_id,
    i.e. orders shipped on their order day, with their fact totals."""
    t = two_batch_run(star, whole=True)[1].tables
    d, o, f = t["dim_date"], t["dim_order"], t["fact_sales"]
    same = o.join(d, (o.order_date_id == d.date_id) & (o.ship_date_id == d.date_id)).select(
        "order_id", "order_key", "full_date")
    return (same.join(f.select("order_id", "sales"), "order_id", "left")
            .groupBy("order_key", "full_date")
            .agg(F.count("sales").alias("n_lines"), F.sum("sales").cast("double").alias("sales")))


def q_location_roles(star: SourceStar) -> DataFrame:
    """Shipping location of the fact vs home location of its customer."""
    t = two_batch_run(star, whole=True)[1].tables
    loc = t["dim_location"]
    ship = loc.select(F.col("location_id"), F.col("region").alias("ship_region"))
    home = loc.select(F.col("location_id").alias("home_location_id"), F.col("region").alias("home_region"))
    cust = t["dim_customer"].select("customer_id", F.col("location_id").alias("home_location_id"))
    return (t["fact_sales"].join(ship, "location_id").join(cust, "customer_id").join(home, "home_location_id", "left")
            .groupBy("ship_region", "home_region")
            .agg(F.count(F.lit(1)).alias("n"), F.sum("sales").cast("double").alias("sales")))


def q_check(kind: str):
    def run(star: SourceStar) -> DataFrame:
        return check_star(two_batch_run(star, whole=True)[1].tables, schemas.CONSTRAINTS, kind)
    return run
