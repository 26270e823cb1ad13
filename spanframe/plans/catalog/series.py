"""Metric-series windows.

The series binding has five runs of equal size, i.e. each run is a fifth of
the table: every ordered computation goes through ``plans.ordered`` (dense
step by distributed range numbering, then (run, block) windows), never a
``partitionBy(run)`` window over raw rows.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ...functions import numeric as N
from ..oracle_sql import with_ctes
from ..ordered import blocked_moving_avg, blocked_running
from ..registry import query

SMOOTH_N = 100
TUMBLE = 200


@query("smooth_valid", with_ctes("series") + f"""
select run, step, round(ma, 6) ma from (
  select run, step, avg(loss) over (partition by run order by step rows between {SMOOTH_N - 1} preceding and current row) ma
  from series) where step >= {SMOOTH_N}""")
def smooth_valid(fx):
    s = blocked_moving_avg(fx.series, ["run"], "step", "loss", SMOOTH_N, "ma")
    return s.select("run", "step", F.round("ma", 6).alias("ma"))


@query("running_mean", with_ctes("series") + """
select run, step, round(sum(loss) over (partition by run order by step rows between unbounded preceding and current row) / step + 1e-12, 6)
  running_mean from series""")
def running_mean(fx):
    s = blocked_running(fx.series, ["run"], "step", "loss", "sum", "_cum")
    # +1e-12: exact decimal midpoints (sums of 2-digit values / step) round the
    # same way in every engine.
    return s.select("run", "step", F.round(F.col("_cum") / F.col("step") + 1e-12, 6).alias("running_mean"))


@query("tumbling_count_mean", with_ctes("series") + f"""
select run, (step - 1) // {TUMBLE} win, round(avg(loss), 6) mean from series
group by run, (step - 1) // {TUMBLE} having count(*) = {TUMBLE}""")
def tumbling_count_mean(fx):
    s = fx.series.withColumn("win", F.floor((F.col("step") - 1) / TUMBLE))
    g = s.groupBy("run", "win").agg(F.avg("loss").alias("mean"), F.count(F.lit(1)).alias("_n"))
    return g.filter(F.col("_n") == TUMBLE).select("run", "win", F.round("mean", 6).alias("mean"))


@query("decimate_steps", with_ctes("series") + """
select run, step, loss from series where step % 100 = 0""")
def decimate_steps(fx):
    return fx.series.filter(F.col("step") % 100 == 0).select("run", "step", "loss")


@query("global_step", with_ctes("series") + """
select run, step, (step - 1) // 1000 + 1 epoch, (step - 1) % 1000 batch_idx,
  ((step - 1) % 1000) * 64 + ((step - 1) // 1000) * 64000 global_example from series""")
def global_step(fx):
    s = fx.series
    epoch = F.floor((F.col("step") - 1) / 1000) + 1
    bidx = (F.col("step") - 1) % 1000
    return s.select("run", "step", epoch.alias("epoch"), bidx.alias("batch_idx"),
                    (bidx * 64 + (epoch - 1) * 64000).alias("global_example"))


@query("new_best_flags", with_ctes("series") + """
select run, step,
  case when max(loss) over w is null or loss > max(loss) over w then 1 else 0 end new_max,
  case when min(loss) over w is null or loss < min(loss) over w then 1 else 0 end new_min
from series window w as (partition by run order by step rows between unbounded preceding and 1 preceding)""")
def new_best_flags(fx):
    s = blocked_running(fx.series, ["run"], "step", "loss", "max", "_pmax", exclusive=True)
    s = blocked_running(s, ["run"], "step", "loss", "min", "_pmin", exclusive=True)
    return s.select("run", "step",
                    F.when(F.col("_pmax").isNull() | (F.col("loss") > F.col("_pmax")), 1).otherwise(0).alias("new_max"),
                    F.when(F.col("_pmin").isNull() | (F.col("loss") < F.col("_pmin")), 1).otherwise(0).alias("new_min"))


EPOCH_ROWS = 100
PATIENCE = 3


@query("early_stop_epoch", with_ctes("series", extra=[
    ("ep", f"select run, (step - 1) // {EPOCH_ROWS} epoch, avg(loss) eloss from series group by run, (step - 1) // {EPOCH_ROWS}"),
    ("imp", """select *, case when min(eloss) over (partition by run order by epoch rows between unbounded preceding and 1 preceding) is null
       or eloss < min(eloss) over (partition by run order by epoch rows between unbounded preceding and 1 preceding) then epoch end imp_epoch from ep"""),
    ("gap", """select *, epoch - max(imp_epoch) over (partition by run order by epoch rows between unbounded preceding and current row) gap from imp""")]) + f"""
select r.run, min(g.epoch) stop_epoch from (select distinct run from series) r left join gap g on g.run = r.run and g.gap >= {PATIENCE}
group by r.run""")
def early_stop_epoch(fx):
    ep = fx.series.groupBy("run", F.floor((F.col("step") - 1) / EPOCH_ROWS).alias("epoch")) \
        .agg(F.avg("loss").alias("eloss")).withColumn("estep", F.col("epoch") + 1)
    ep = blocked_running(ep, ["run"], "estep", "eloss", "min", "_pmin", exclusive=True)
    ep = ep.withColumn("imp_epoch", F.when(F.col("_pmin").isNull() | (F.col("eloss") < F.col("_pmin")), F.col("epoch")))
    ep = blocked_running(ep, ["run"], "estep", "imp_epoch", "max", "_last_imp")
    stops = ep.filter(F.col("epoch") - F.col("_last_imp") >= PATIENCE).groupBy("run") \
        .agg(F.min("epoch").alias("stop_epoch"))
    runs = fx.series.select("run").distinct()
    return runs.join(stops, "run", "left")


@query("lr_schedule", with_ctes("series", extra=[("tot", "select run, max(step) total from series group by run")]) + """
select s.run, s.step,
  round(case when s.step < 100 then s.step / 100.0 * 2e-5
        else greatest(0.0, 0.5 * (1.0 + cos(pi() * 2.0 * 0.5 * (s.step - 100) / greatest(1.0, t.total - 100.0)))) * 2e-5 end, 12) lr_cosine,
  round(case when s.step < 100 then s.step / 100.0 * 2e-5
        else greatest(0.0, (t.total - s.step) / greatest(1.0, t.total - 100.0)) * 2e-5 end, 12) lr_linear,
  round(0.01 * pow(0.5, floor(((s.step - 1) // 1000) / 3)), 12) lr_step,
  round(1e-3 * pow(0.6, (s.step - 1) // 1000), 12) lr_exp
from series s join tot t using (run)""")
def lr_schedule(fx):
    s = fx.series
    tot = s.groupBy("run").agg(F.max("step").alias("total")).withColumnRenamed("run", "t_run")
    j = s.join(tot, F.col("run").eqNullSafe(F.col("t_run")))
    epoch = F.floor((F.col("step") - 1) / 1000)
    return j.select("run", "step", F.round(N.cosine_warmup_lr("step", 2e-5, 100, "total"), 12).alias("lr_cosine"),
                    F.round(N.linear_warmup_lr("step", 2e-5, 100, "total"), 12).alias("lr_linear"),
                    F.round(N.step_decay_lr(epoch, 0.01, 3, 0.5), 12).alias("lr_step"),
                    F.round(N.exp_decay_lr(epoch, 1e-3, 0.6), 12).alias("lr_exp"))


@query("format_minutes", """
with t as (select event_id, value * 60 s, value * 60 / ((event_id % 9 + 1) / 10.0) - value * 60 r from events)
select event_id, format('{:d}m {:d}s', floor(s / 60)::bigint, floor(s - floor(s / 60) * 60)::bigint) elapsed,
  format('{:d}m {:d}s (remain {:d}m {:d}s)', floor(s / 60)::bigint, floor(s - floor(s / 60) * 60)::bigint,
    floor(r / 60)::bigint, floor(r - floor(r / 60) * 60)::bigint) since from t""")
def format_minutes(fx):
    sec = F.col("value") * 60
    share = (F.col("event_id") % 9 + 1) / F.lit(10.0)
    return fx.t.events.select("event_id", N.format_minutes(sec).alias("elapsed"), N.time_since(sec, share).alias("since"))
