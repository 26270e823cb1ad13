"""Step 0/1: fixtures and the first end-to-end queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..oracle_sql import with_ctes
from ..registry import query


@query("rows_per_case", with_ctes("train") + """
select case_num, count(*) n_rows from train group by case_num""")
def rows_per_case(fx):
    return fx.train.groupBy("case_num").agg(F.count(F.lit(1)).alias("n_rows"))


@query("token_offsets", with_ctes("tokens") + "select * from tokens")
def token_offsets(fx):
    return fx.tokens


@query("flagship_labelled_tokens_per_case", with_ctes("pieces", "tokens", "train") + """
, lab as (select p.id, t.tok_no, max(case when greatest(least(t.e, p.re) + 1 - greatest(t.s, p.rs), 0) / (t.e + 1 - t.s) > 0.9
    then 1 else 0 end) score from pieces p join tokens t using (pn_num) group by p.id, t.tok_no)
select tr.case_num, count(*) n_tokens, sum(score)::bigint n_pos,
  round(sum(1 - score) / sum(score), 6) neg_pos_ratio
from lab join train tr using (id) group by tr.case_num""")
def flagship_labelled_tokens_per_case(fx):
    """Minimum slice end to end: train -> parse spans -> note tokens ->
    overlap labels -> per-case labelled-token counts and class ratio."""
    from ...operators.labels import label_overlap90

    lab = label_overlap90(fx.packed_with_spans)
    cases = fx.train.select("id", "case_num")
    return (lab.join(cases, "id").groupBy("case_num")
            .agg(F.count(F.lit(1)).alias("n_tokens"), F.sum("score").cast("long").alias("n_pos"),
                 F.round(F.sum(1 - F.col("score")) / F.sum("score"), 6).alias("neg_pos_ratio")))
