"""Projections, filters, dimension joins, simple aggregates, text cleaning.

SURVEY 2.2 (B*), 2.3 (C1-C4, C15, C17, C19), 2.4 (D1-D9), 2.9 (H1-H5).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import functions as F

from ...functions import spans as S
from ...functions import text as X
from ...operators import frames as FR
from ...operators import packed as PK
from ..oracle_sql import with_ctes
from ..registry import query

PARSED = """select id, location, len(list_filter(string_split_regex(translate(location, '[]''', ''), '[,;]'),
   lambda x: trim(x) <> '')) n_spans from train"""


@query("project_train_columns", with_ctes("merged") + """
select id, feature_text, pn_history, location from merged""")
def project_train_columns(fx):
    return fx.merged.select("id", "feature_text", "pn_history", "location")


@query("project_keep_only", with_ctes("merged") + "select id, pn_num, location from merged")
def project_keep_only(fx):
    return FR.keep_only(fx.merged, ["id", "pn_num", "location"])


@query("project_by_dtype", with_ctes("passengers") + """
select pid, age, nationkey, segment, nation from passengers""")
def project_by_dtype(fx):
    """The numeric and the categorical columns as frames of their own (the label
    left out), put side by side again."""
    numeric, categorical = FR.split_by_dtype(fx.passengers, label="survived", key="pid")
    return numeric.join(categorical, "pid")


@query("filter_nonempty_spans", with_ctes("train", extra=[("p", PARSED)]) + """
select id, location from p where n_spans > 0""")
def filter_nonempty_spans(fx):
    return fx.train.filter(F.size(S.parse_loc_strip_split("location")) > 0).select("id", "location")


@query("filter_empty_spans", with_ctes("train", extra=[("p", PARSED)]) + """
select id, location from p where n_spans = 0""")
def filter_empty_spans(fx):
    t = fx.train.select("id", "location")
    t = PK.once(t.withColumn("n_spans", F.size(S.parse_loc_strip_split("location"))), "location", "n_spans")
    return t.filter(F.col("n_spans") == 0).select("id", "location")


@query("filter_no_positive", with_ctes("pred_tok") + """
select pn_num, feature_num, count(*) n_tokens, sum(label)::bigint n_pos from pred_tok
group by pn_num, feature_num having sum(label) > 0""")
def filter_no_positive(fx):
    return FR.rows_with_positive(fx.token_pairs, ["pn_num", "feature_num"], "label")


@query("lookup_patient", with_ctes("train") + """
select id, pn_num, feature_num, location from train where pn_num = 7""")
def lookup_patient(fx):
    return fx.train.filter(F.col("pn_num") == 7).select("id", "pn_num", "feature_num", "location")


@query("lookup_feature_text", with_ctes("features") + """
select feature_num, case_num, feature_text from features
where feature_text = (select feature_text from features where feature_num = 3)""")
def lookup_feature_text(fx):
    f = fx.features
    probe = f.filter(F.col("feature_num") == 3).select(F.col("feature_text").alias("_probe"))

    return f.join(probe, F.col("feature_text") == F.col("_probe")) \
        .select("feature_num", "case_num", "feature_text")


@query("threshold_binary", with_ctes("pred_tok") + """
select pn_num, feature_num, tok_no, (prob >= 0.5)::int ge05, (prob > 0.5)::int gt05,
  (prob > 0.9)::int gt09 from pred_tok""")
def threshold_binary(fx):
    from ...functions.numeric import threshold

    p = fx.pred_tok
    return p.select("pn_num", "feature_num", "tok_no",
                    threshold("prob", 0.5, inclusive=True).alias("ge05"),
                    threshold("prob", 0.5, inclusive=False).alias("gt05"),
                    threshold("prob", 0.9, inclusive=False).alias("gt09"))


@query("drop_null_rows", with_ctes("passengers") + """
select * from passengers where pid is not null and age is not null and segment is not null
  and nationkey is not null and nation is not null and survived is not null""")
def drop_null_rows(fx):
    return fx.passengers.na.drop("any")


@query("rows_with_null", with_ctes("passengers") + """
select * from passengers where pid is null or age is null or segment is null
  or nationkey is null or nation is null or survived is null""")
def rows_with_null(fx):
    p = fx.passengers
    return p.filter(reduce(lambda a, b: a | b, [F.col(c).isNull() for c in p.columns]))


# Corrections keyed by id (never by row position): rows with a discontinuous
# first annotation are corrected to their first piece only.
CORR_SQL = """select id, '[''' || split_part(split_part(translate(annotation, '[]''', ''), ',', 1), ' ', 1) || ''']' annotation,
  '[''' || split_part(split_part(translate(location, '[]''', ''), ',', 1), ';', 1) || ''']' location
  from train where location like '%;%'"""


@query("overlay_corrections", with_ctes("train", extra=[("corr", CORR_SQL)]) + """
select t.id, coalesce(c.annotation, t.annotation) annotation, coalesce(c.location, t.location) location
from train t left join corr c using (id)""")
def overlay_corrections(fx):
    t = fx.train
    first = lambda c, sep: F.split(F.split(F.translate(F.col(c), "[]'", ""), ",").getItem(0), sep).getItem(0)
    corr = t.filter(F.col("location").contains(";")).select(
        "id", F.concat(F.lit("['"), first("annotation", " "), F.lit("']")).alias("annotation"),
        F.concat(F.lit("['"), first("location", ";"), F.lit("']")).alias("location"))
    return FR.overlay(t.select("id", "annotation", "location"), corr, "id", ["annotation", "location"])


@query("with_defaults", with_ctes("train") + """
select id, case_num, pn_num, feature_num, '' target, '' annotation, '-1 -1' location from train""")
def with_defaults(fx):
    t = fx.train.select("id", "case_num", "pn_num", "feature_num")
    return FR.with_defaults(t, {"target": "", "annotation": "", "location": "-1 -1"})


@query("annotation_length", with_ctes("train") + """
select id, len(cast(replace(annotation, '''', '"') as varchar[]))::int annotation_length from train""")
def annotation_length(fx):
    return fx.train.select("id", F.coalesce(F.size(S.parse_string_list("annotation")), F.lit(0))
                           .cast("int").alias("annotation_length"))


@query("split_row_id", with_ctes("train") + """
select id, try_cast(split_part(id, '_', 1) as bigint) pn_key, try_cast(split_part(id, '_', 2) as bigint) feature_key
from train""")
def split_row_id(fx):
    return FR.split_row_id(fx.train, "id")


# ---- joins -----------------------------------------------------------------

@query("join_features_left", with_ctes("train", "features") + """
select t.id, t.feature_num, t.case_num, f.feature_text from train t
left join features f on t.feature_num = f.feature_num and t.case_num = f.case_num""")
def join_features_left(fx):
    return fx.train.join(fx.features, ["feature_num", "case_num"], "left") \
        .select("id", "feature_num", "case_num", "feature_text")


@query("join_notes_left", with_ctes("merged") + """
select id, pn_num, case_num, feature_text, pn_history from merged""")
def join_notes_left(fx):
    return fx.merged.select("id", "pn_num", "case_num", "feature_text", "pn_history")


@query("join_inner_chain", with_ctes("train", "features", "notes") + """
select t.id, t.case_num, t.pn_num, t.feature_num, n.pn_history, f.feature_text
from train t join notes n on t.pn_num = n.pn_num and t.case_num = n.case_num
join features f on t.feature_num = f.feature_num and t.case_num = f.case_num""")
def join_inner_chain(fx):
    test = fx.train.select("id", "case_num", "pn_num", "feature_num")
    return (test.join(fx.notes, ["pn_num", "case_num"])
            .join(fx.features, ["feature_num", "case_num"])
            .select("id", "case_num", "pn_num", "feature_num", "pn_history", "feature_text"))


@query("join_natural_left", with_ctes("train", "notes") + """
select t.*, n.pn_history from train t natural left join notes n""")
def join_natural_left(fx):
    return FR.natural_join(fx.train, fx.notes, "left")


@query("label_names", """
select e.vec_id, e.label, n.n_name class_name from embeddings e left join nation n on e.label = n.n_nationkey""")
def label_names(fx):
    e = fx.t.embeddings.select("vec_id", "label")

    names = fx.t.nation.select(F.col("n_nationkey").alias("label"),
                                                 F.col("n_name").alias("class_name"))
    return e.join(names, "label", "left").select("vec_id", "label", "class_name")


@query("verify_annotation_span", with_ctes("merged") + """
select id, elem_no, ann, found_start, found_end, loc, (loc = found_start || ' ' || found_end) ok from (
  select id, elem_no, ann, loc, strpos(pn_history, ann) - 1 found_start,
    case when strpos(pn_history, ann) = 0 then -1 else strpos(pn_history, ann) - 1 + length(ann) end found_end
  from (select id, pn_history, unnest(a) ann, unnest(l) loc, unnest(range(1, len(a) + 1)) elem_no from (
    select id, pn_history, cast(replace(annotation, '''', '"') as varchar[]) a,
      cast(replace(location, '''', '"') as varchar[]) l from merged where annotation <> '[]')))""")
def verify_annotation_span(fx):
    return FR.verify_annotation_spans(fx.merged.filter(F.col("annotation") != "[]"))


# ---- aggregates ------------------------------------------------------------

@query("value_counts_label", with_ctes("tweets") + """
select label, count(*) n from tweets group by label""")
def value_counts_label(fx):
    return fx.tweets.groupBy("label").agg(F.count(F.lit(1)).alias("n"))


@query("rows_per_feature", with_ctes("merged") + """
select feature_num, count(*) n_rows, min(feature_text) feature_text from merged group by feature_num""")
def rows_per_feature(fx):
    return fx.merged.groupBy("feature_num").agg(F.count(F.lit(1)).alias("n_rows"),
                                                 F.min("feature_text").alias("feature_text"))


@query("pct_without_span", with_ctes("train", extra=[("p", PARSED)]) + """
select round(avg(case when n_spans = 0 then 1.0 else 0.0 end), 6) share,
  round(100 * avg(case when n_spans = 0 then 1.0 else 0.0 end))::int pct,
  format('{:d}%', round(100 * avg(case when n_spans = 0 then 1.0 else 0.0 end))::int) pct_text from p""")
def pct_without_span(fx):
    return FR.share_without_spans(fx.train, S.parse_loc_strip_split("location"))


@query("table_shapes", with_ctes("train", "features", "notes") + """
select 'train' tbl, (select count(*) from train) n_rows, 6 n_cols
union all select 'features', (select count(*) from features), 4
union all select 'notes', (select count(*) from notes), 3""")
def table_shapes(fx):
    return FR.table_shapes({"train": fx.train, "features": fx.features, "notes": fx.notes})


@query("distinct_texts", with_ctes("notes") + """
select count(*) n_notes, count(distinct pn_history) n_distinct_texts from notes""")
def distinct_texts(fx):
    return fx.notes.agg(F.count(F.lit(1)).alias("n_notes"),
                        F.countDistinct(F.sha2("pn_history", 256)).alias("n_distinct_texts"))


@query("collect_targets_per_note", with_ctes("train") + """
select pn_num, count(*) n_targets, string_agg(id, ',' order by feature_num) ids from train group by pn_num""")
def collect_targets_per_note(fx):
    return FR.collect_targets(fx.train, "pn_num", "feature_num", "id")


# ---- text cleaning ---------------------------------------------------------

@query("norm_feature_text", with_ctes("features") + """
select feature_num, replace(replace(replace(feature_text, 'I-year', '1-year'), '-OR-', ' or '), '-', ' ') feature_text
from features""")
def norm_feature_text(fx):
    return fx.features.select("feature_num", X.norm_feature_text("feature_text").alias("feature_text"))


@query("norm_feature_text_alt", with_ctes("features") + """
select feature_num, replace(replace(feature_text, '-OR-', ' or '), '-', ' ') train_text,
  replace(replace(replace(replace(replace(feature_text, '-OR-', ';-'), '-', ' '), chr(10), ' '), chr(13), ' '), chr(9), ' ') submission_text
from features""")
def norm_feature_text_alt(fx):
    return fx.features.select("feature_num",
                              X.norm_feature_text_train("feature_text").alias("train_text"),
                              X.norm_text_submission("feature_text").alias("submission_text"))


@query("clean_spaces", with_ctes("notes") + """
select pn_num, translate(pn_history, chr(10) || chr(9) || chr(13), '   ') clean_text from notes""")
def clean_spaces(fx):
    return fx.notes.select("pn_num", X.clean_spaces("pn_history").alias("clean_text"))


@query("strip_note", with_ctes("notes") + """
select pn_num, trim(pn_history, b) stripped, (length(pn_history) - length(ltrim(pn_history, b)))::int shift
from notes, (select array_to_string(list_transform([9, 10, 11, 12, 13, 28, 29, 30, 31, 32, 133, 160, 5760, 8192, 8193, 8194,
  8195, 8196, 8197, 8198, 8199, 8200, 8201, 8202, 8232, 8233, 8239, 8287, 12288], lambda c: chr(c::int)), '') b)""")
def strip_note(fx):
    return fx.notes.select("pn_num", X.strip_note("pn_history").alias("stripped"),
                           X.strip_shift("pn_history").cast("int").alias("shift"))

