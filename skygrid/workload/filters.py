"""Pixel quality filters."""

from pyspark.sql import functions as F

from skygrid.functions.time import in_date_range
from skygrid.operators import qc
from skygrid.plans.grid import FILTER_BOX
from skygrid.workload.helpers import R6, r6
from skygrid.workload.registry import query

BOX = "lon between 120 and 122 and lat between 22 and 25"


def _pixels(df):
    return df.select("pixel_id", r6("value").alias("value"))


def _sql(where: str) -> str:
    return f"select pixel_id, {R6('value')} as value from v_pixel where {where}"


@query("F1_bbox_filter", ["v_pixel"], _sql(BOX))
def f1(t):
    return _pixels(qc.bbox_filter(t.pixel, FILTER_BOX))


@query("F2_qa_filter", ["v_pixel"], _sql("qa >= 0.5"))
def f2(t):
    return _pixels(qc.qa_filter(t.pixel, 0.5))


@query("F3_flag_filter", ["v_pixel"], _sql("flag = 0"))
def f3(t):
    return _pixels(qc.flag_filter(t.pixel))


@query("F4_cloud_filter", ["v_pixel"], _sql("cloud <= 0.4"))
def f4(t):
    return _pixels(qc.cloud_filter(t.pixel, 0.4))


@query("F5_positive_filter", ["v_pixel"], f"select pixel_id, {R6('value - 20e0')} as value from v_pixel where value - 20e0 > 0")
def f5(t):
    return _pixels(qc.positive_filter(t.pixel.withColumn("value", F.col("value") - 20.0)))


@query("F6_cap_filter", ["v_pixel"], _sql("value > 0 and value <= 40"))
def f6(t):
    return _pixels(qc.cap_filter(t.pixel, 40.0))


@query("F7_finite_filter", ["v_pixel"], _sql("value is not null and qa > 0"))
def f7(t):
    """Where qa is 0 the value is replaced by NaN, as a reader of dense files would see it."""
    return _pixels(qc.finite_filter(t.pixel.withColumn("value", F.when(F.col("qa") == 0, float("nan")).otherwise(F.col("value")))))


@query("F8_min_points", ["v_pixel"], """
select granule_id, qa, count(*) as n from v_pixel group by granule_id, qa having count(*) >= 10
union all select granule_id, null, count(*) from v_pixel group by granule_id having count(*) >= 10""")
def f8(t):
    """Granules, and quality bands of granules, with at least ten rows."""
    bands = qc.min_points(t.pixel, ("granule_id", "qa")).groupBy("granule_id", "qa").agg(F.count("*").alias("n"))
    whole = qc.min_points(t.pixel).groupBy("granule_id").agg(F.count("*").alias("n"))
    return bands.unionByName(whole.withColumn("qa", F.lit(None).cast("double")))


@query("F9_require_region_data", ["v_pixel"], """
select granule_id, count(*) as n from v_pixel where granule_id in (
  select granule_id from v_pixel where value > 120 and lat between 24 and 25 and lon between 120.5 and 121.5) group by granule_id""")
def f9(t):
    """Lower values are empty, as a reader would hand them over; the operator has to see that."""
    return (qc.require_data_in_box(t.pixel.withColumn("value", F.when(F.col("value") > 120, F.col("value"))), (120.5, 121.5, 24.0, 25.0))
            .groupBy("granule_id").agg(F.count("*").alias("n")))


@query("F10_has_valid_in_box", ["v_pixel"], f"""
select granule_id, count(*) as n from v_pixel where granule_id in (
  select granule_id from v_pixel where value > 250 and {BOX}) group by granule_id""")
def f10(t):
    """Lower values are not a number; the operator has to see that."""
    return (qc.require_data_in_box(t.pixel.withColumn("value", F.when(F.col("value") > 250, F.col("value")).otherwise(float("nan"))), FILTER_BOX)
            .groupBy("granule_id").agg(F.count("*").alias("n")))


@query("F11_date_range", ["v_pixel"], """
select 'end_of_day' as rule, count(*) as n, max(pixel_id) as last_id from v_pixel
where obs_time between timestamp '2024-01-05 00:00:00' and timestamp '2024-01-20 23:59:59'
union all select 'midnight', count(*), max(pixel_id) from v_pixel
where obs_time between timestamp '2024-01-05 00:00:00' and timestamp '2024-01-20 00:00:00'""")
def f11(t):
    def part(rule, midnight):
        kept = t.pixel.where(in_date_range(F.col("obs_time"), "2024-01-05", "2024-01-20", midnight))
        return kept.agg(F.count("*").alias("n"), F.max("pixel_id").alias("last_id")).select(F.lit(rule).alias("rule"), "n", "last_id")
    return part("end_of_day", False).unionByName(part("midnight", True))


@query("F12_drop_zero_fill", ["v_pixel"], f"""
with coded as (select pixel_id, case when flag = 1 then 0e0 when qa = 0 then -28672e0 else value end as value from v_pixel)
select pixel_id, {R6('value')} as value from coded where value is not null and value not in (0, -28672)""")
def f12(t):
    coded = F.when(F.col("flag") == 1, 0.0).when(F.col("qa") == 0, -28672.0).otherwise(F.col("value"))
    return _pixels(qc.drop_zero_fill(t.pixel.withColumn("value", coded)))


@query("F_swath_qc_chain", ["v_pixel"], f"""
with ok as (select * from v_pixel where value > 0 and flag = 0 and cloud <= 0.8 and {BOX})
select granule_id, count(*) as n, {R6('avg(value)')} as mean from ok group by granule_id having count(*) >= 10""")
def f_chain(t):
    """All filters of one source in their order; every one of them is pushed to the scan."""
    kept = qc.swath_qc(t.pixel, bounds=FILTER_BOX, cloud_max=0.8)
    return kept.groupBy("granule_id").agg(F.count("*").alias("n"), r6(F.avg("value")).alias("mean"))
