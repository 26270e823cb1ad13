"""Evaluation metrics, folds and CV roll-ups."""

from __future__ import annotations

from pyspark.sql import functions as F

from ...functions import numeric as N
from ...functions.numeric import bce
from ...functions import spans as S
from ...operators import folds as FO
from ...operators import metrics as M
from ...operators import packed as PK
from ..fixtures import md5_unit
from ..oracle_sql import with_ctes
from ..registry import query

ROW = ["pn_num", "feature_num"]
IDENTITIES = ["id_fr", "id_de", "id_es"]


def row_counts(rows, pred, truth="spans"):
    """(pn_num, feature_num, tp, fp, fn): chars of two span lists of a packed row."""
    rows = PK.once(rows.select(*ROW, pred, truth), pred, truth)  # starts and ends are read from each
    return rows.select(*ROW, PK.overlap_lengths(F.col(pred), F.col(truth)).alias("c")).select(*ROW, "c.tp", "c.fp", "c.fn")


def _char_counts(scored):
    """Chars of the tokens at or above 0.5 against the chars of the true spans; tokens, scores and truth are in one row."""
    return row_counts(PK.char_runs(scored, lambda x: x["prob"] >= 0.5, "pred"), "pred")


FOLDS_SQL = """select pn_num, (row_number() over (order by cnt desc, pn_num) - 1) % 5 fold
  from (select pn_num, count(*) cnt from train group by pn_num)"""

CHARSETS = [
    ("pc", "select distinct pn_num, feature_num, unnest(range(s, e)) c from pred_tok where prob >= 0.5"),
    ("tc", "select distinct pn_num, feature_num, unnest(range(rs, re)) c from pieces"),
    ("cj", """select coalesce(p.pn_num, t.pn_num) pn_num, coalesce(p.feature_num, t.feature_num) feature_num,
       (p.c is not null) ip, (t.c is not null) it
       from pc p full outer join tc t on p.pn_num = t.pn_num and p.feature_num = t.feature_num and p.c = t.c"""),
]


@query("char_micro_f1", with_ctes("pred_tok", "pieces", extra=CHARSETS) + """
select tp, fp, fn, round(case when 2 * tp + fp + fn > 0 then 2.0 * tp / (2 * tp + fp + fn) else 0 end, 6) f1 from (
  select count(*) filter (where ip and it) tp, count(*) filter (where ip and not it) fp,
         count(*) filter (where it and not ip) fn from cj)""")
def char_micro_f1(fx):
    return M.micro_f1(_char_counts(fx.scored))


@query("group_kfold", with_ctes("train", extra=[("fo", FOLDS_SQL)]) + """
select t.id, t.pn_num, fo.fold from train t join fo using (pn_num)""")
def group_kfold(fx):
    return FO.group_kfold(fx.train.select("id", "pn_num"), "pn_num", 5).select("id", "pn_num", "fold")


@query("split_fold_train_valid", with_ctes("train", extra=[("fo", FOLDS_SQL)]) + """
select t.id, fo.fold, case when fo.fold <> 0 then 'train' else 'valid' end part from train t join fo using (pn_num)""")
def split_fold_train_valid(fx):
    f = FO.group_kfold(fx.train.select("id", "pn_num"), "pn_num", 5)
    return f.select("id", "fold", F.when(F.col("fold") != 0, "train").otherwise("valid").alias("part"))


@query("cv_scores_rollup", with_ctes("pred_tok", "pieces", "train", extra=CHARSETS + [("fo", FOLDS_SQL)]) + """
select fold, tp, fp, fn, round(case when 2 * tp + fp + fn > 0 then 2.0 * tp / (2 * tp + fp + fn) else 0 end, 6) f1 from (
  select fo.fold, count(*) filter (where ip and it) tp, count(*) filter (where ip and not it) fp,
         count(*) filter (where it and not ip) fn from cj join fo using (pn_num) group by rollup(fo.fold))""")
def cv_scores_rollup(fx):
    counts = _char_counts(fx.scored_by_batch)
    folds = FO.group_kfold(fx.train.select("pn_num").distinct(), "pn_num", 5)
    return M.micro_f1_rollup(counts.join(folds, "pn_num"), "fold")


CHAR_PRF_RUNS = [
    # a run of tokens above the threshold counts only once a token below it follows, and never from or to offset 0;
    # a run that starts at 0 stays open and takes all later runs with it
    ("isl", """select *, tok_no - row_number() over (partition by pn_num, feature_num order by tok_no) g
       from pred_tok where prob > 0.5"""),
    ("run", "select pn_num, feature_num, min(s) a, max(e) b, max(tok_no) lt from isl group by pn_num, feature_num, g"),
    ("fin", "select pn_num, feature_num, max(tok_no) last_tok from pred_tok group by pn_num, feature_num"),
    ("zero", "select distinct pn_num, feature_num from run where a = 0"),
    ("emit", """select run.* from run join fin using (pn_num, feature_num)
       where lt < last_tok and b <> 0 and (pn_num, feature_num) not in (select (pn_num, feature_num) from zero)"""),
    ("pc", "select distinct pn_num, feature_num, unnest(range(a, b)) c from emit"),
    ("tc", "select distinct pn_num, feature_num, unnest(range(rs, re)) c from pieces"),
]


@query("char_prf", with_ctes("pred_tok", "pieces", extra=CHAR_PRF_RUNS + [
    ("cnt", """select count(*) filter (where p.c is not null and t.c is not null) tp,
       count(*) filter (where t.c is null) fp, count(*) filter (where p.c is null) fn
       from pc p full outer join tc t on p.pn_num = t.pn_num and p.feature_num = t.feature_num and p.c = t.c""")]) + """
select round(case when tp + fp > 0 then tp / (tp + fp) else 0 end, 6) "precision",
  round(case when tp + fn > 0 then tp / (tp + fn) else 0 end, 6) recall,
  round(case when tp > 0 then 2 * (tp / (tp + fp)) * (tp / (tp + fn)) / ((tp / (tp + fp)) + (tp / (tp + fn))) else 0 end, 6) f1,
  null::bigint support from cnt""")
def char_prf(fx):
    """Chars of the decoded runs (no-flush rule) against the chars of the true spans."""
    loc = PK.decode_tokens(fx.scored, th=0.5).withColumn("pred", S.parse_loc_prediction("noflush"))
    return M.prf(row_counts(loc, "pred"))


@query("row_mean_f1", with_ctes("pred_tok") + """
select round(avg(case when 2 * tp + fp + fn > 0 then 2.0 * tp / (2 * tp + fp + fn) else 0 end), 6) mean_f1, count(*) n_rows from (
  select pn_num, feature_num, sum(case when prob >= 0.5 and label = 1 then 1 else 0 end) tp,
    sum(case when prob >= 0.5 and label = 0 then 1 else 0 end) fp, sum(case when prob < 0.5 and label = 1 then 1 else 0 end) fn
  from pred_tok group by pn_num, feature_num)""")
def row_mean_f1(fx):
    pred = F.when(F.col("prob") >= 0.5, 1).otherwise(0)
    return M.row_mean_f1(fx.pred_tok, ROW, pred, "label")


AUC_SQL = """with g as (select prob, sum(label) p, count(*) - sum(label) n from pred_tok group by prob),
     w as (select *, coalesce(sum(n) over (order by prob rows between unbounded preceding and 1 preceding), 0) below from g)
select round(sum(p * (below + n / 2.0)) / (sum(p) * 1.0 * sum(n)), 6) auc from w"""


@query("roc_auc", with_ctes("pred_tok") + AUC_SQL.replace("with g as", ", g as", 1))
def roc_auc(fx):
    return M.roc_auc(fx.pred_tok, "label", "prob").select(F.round("auc", 6).alias("auc"))


def _bias_long_sql():
    parts = []
    for i in IDENTITIES:
        f = f"(case when {i} >= 0.5 then 1 else 0 end)"
        y = "(case when target >= 0.5 then 1 else 0 end)"
        parts.append(f"select '{i}' identity, 'subgroup_auc' metric, {y} y, prediction score from bias_rows where {f} = 1")
        parts.append(f"select '{i}', 'bpsn_auc', {y}, prediction from bias_rows where ({f} = 1 and {y} = 0) or ({f} = 0 and {y} = 1)")
        parts.append(f"select '{i}', 'bnsp_auc', {y}, prediction from bias_rows where ({f} = 1 and {y} = 1) or ({f} = 0 and {y} = 0)")
    return " union all ".join(parts)


BIAS_CTES = [
    ("lng", _bias_long_sql()),
    ("g", "select identity, metric, score, sum(y) p, count(*) - sum(y) n from lng group by identity, metric, score"),
    ("w", """select *, coalesce(sum(n) over (partition by identity, metric order by score
       rows between unbounded preceding and 1 preceding), 0) below from g"""),
    ("a", """select identity, metric, case when sum(p) > 0 and sum(n) > 0 then sum(p * (below + n / 2.0)) / (sum(p) * 1.0 * sum(n)) end auc
       from w group by identity, metric"""),
    ("grid", "select * from (values " + ", ".join(
        f"('{i}', '{m}')" for i in IDENTITIES for m in ("subgroup_auc", "bpsn_auc", "bnsp_auc")) + ") v(identity, metric)"),
    ("ba", "select grid.identity, grid.metric, coalesce(a.auc, 1.0) auc from grid left join a using (identity, metric)"),
]


@query("subgroup_auc", with_ctes("bias_rows", extra=BIAS_CTES) + """
select identity, metric, round(auc, 6) auc from ba""")
def subgroup_auc(fx):
    b = M.bias_aucs(fx.bias_rows, IDENTITIES)
    return b.select("identity", "metric", F.round("auc", 6).alias("auc"))


@query("total_bias_auc", with_ctes("bias_rows", extra=BIAS_CTES + [
    ("og", "select prediction score, sum(case when target >= 0.5 then 1 else 0 end) p, count(*) - sum(case when target >= 0.5 then 1 else 0 end) n from bias_rows group by prediction"),
    ("ow", "select *, coalesce(sum(n) over (order by score rows between unbounded preceding and 1 preceding), 0) below from og"),
    ("oa", "select sum(p * (below + n / 2.0)) / (sum(p) * 1.0 * sum(n)) auc from ow"),
    ("pm", "select metric, power(avg(power(auc, -5)), 1.0 / -5) v from ba group by metric")]) + """
select round(((select sum(v) from pm) + (select auc from oa)) / 4.0, 6) total_auc""")
def total_bias_auc(fx):
    return M.total_bias_auc(fx.bias_rows, IDENTITIES).select(F.round("total_auc", 6).alias("total_auc"))


@query("bias_sample_weights", with_ctes("bias_rows", extra=[("wt", """select doc_id,
   0.25 + 0.25 * (case when id_fr >= 0.5 or id_de >= 0.5 or id_es >= 0.5 then 1 else 0 end)
   + 0.25 * (case when target >= 0.5 and (id_fr < 0.5 or id_de < 0.5 or id_es < 0.5) then 1 else 0 end)
   + 0.25 * (case when target < 0.5 and (id_fr >= 0.5 or id_de >= 0.5 or id_es >= 0.5) then 1 else 0 end) w from bias_rows""")]) + """
select doc_id, round(w::double, 6) weight, round(1.0 / (select avg(w::double) from wt), 6) loss_weight from wt""")
def bias_sample_weights(fx):
    from ...operators.bias import sample_weights

    return sample_weights(fx.bias_rows, IDENTITIES)


@query("ensemble_weighted_avg", with_ctes("bias_rows") + """
select doc_id, round(sum(p * w) / sum(w), 6) p from (
  select doc_id, pow(2, ep) w, 0.5 * target + 0.5 * (('0x' || substr(md5(doc_id || '_' || ep), 1, 8))::bigint / 4294967296.0) p
  from bias_rows, range(0, 4) r(ep)) group by doc_id""")
def ensemble_weighted_avg(fx):
    b = fx.bias_rows.select("doc_id", "target", F.explode(F.sequence(F.lit(0), F.lit(3))).alias("ep"))
    b = b.select("doc_id", F.pow(F.lit(2.0), F.col("ep")).alias("w"),
                 (0.5 * F.col("target") + 0.5 * md5_unit("doc_id", "ep")).alias("p"))
    return b.groupBy("doc_id").agg(F.round(F.sum(F.col("p") * F.col("w")) / F.sum("w"), 6).alias("p"))


SOFTMAX_SQL = """select vec_id, label, cls, exp(score - max(score) over (partition by vec_id))
   / sum(exp(score - max(score) over (partition by vec_id))) over (partition by vec_id) prob from class_scores"""


def _softmax_long(fx):
    """(vec_id, label, cls, prob): softmax inside the row, then exploded."""
    p = fx.class_scores.select("vec_id", "label", "scores", N.softmax(F.col("scores")["score"]).alias("p"))
    z = F.zip_with("scores", "p", lambda s, q: F.struct(s["cls"].alias("cls"), q.alias("prob")))
    return p.select("vec_id", "label", F.explode(z).alias("x")).select("vec_id", "label", "x.cls", "x.prob")


@query("pr_curve_per_class", with_ctes("class_scores", extra=[
    ("sm", """select vec_id, label, cls, ex / sum(ex) over (partition by vec_id) prob from (
       select *, exp(score - max(score) over (partition by vec_id)) ex from class_scores)"""),
    ("t", "select range / 10.0 threshold from range(0, 11)"),
    ("c", """select cls, threshold, count(*) filter (where prob >= threshold and label = cls) tp,
       count(*) filter (where prob >= threshold and label <> cls) fp,
       count(*) filter (where prob < threshold and label = cls) fn from sm, t group by cls, threshold""")]) + """
select cls, threshold, tp, fp, fn, round(case when tp + fp > 0 then tp / (tp + fp) end, 6) "precision",
  round(case when tp + fn > 0 then tp / (tp + fn) end, 6) recall from c""")
def pr_curve_per_class(fx):
    sm = _softmax_long(fx)
    return M.threshold_grid_counts(sm, "cls", "prob", F.when(F.col("label") == F.col("cls"), 1).otherwise(0))


@query("pr_curve_by_score", with_ctes("class_scores", extra=[
    ("sm", """select label, cls, round(ex / sum(ex) over (partition by vec_id), 4) score from (
       select *, exp(score - max(score) over (partition by vec_id)) ex from class_scores)"""),
    ("c", "select cls, score threshold, count(*) filter (where label = cls) p, count(*) filter (where label <> cls) n from sm group by all"),
    ("w", """select *, sum(p) over (partition by cls order by threshold desc) tp,
       sum(n) over (partition by cls order by threshold desc) fp, sum(p) over (partition by cls) a from c""")]) + """
select cls, threshold, tp::bigint tp, fp::bigint fp, (a - tp)::bigint fn, round(tp / (tp + fp), 6) "precision",
  round(case when a > 0 then tp / a end, 6) recall from w""")
def pr_curve_by_score(fx):
    """The whole curve: one point for each distinct score (4 digits) of a class."""
    sm = _softmax_long(fx).withColumn("score", F.round("prob", 4))
    return M.pr_curve(sm, "cls", "score", F.when(F.col("label") == F.col("cls"), 1).otherwise(0))


@query("nonzero_outputs", with_ctes("pred_tok") + """
select feature_num, count(*) filter (where round_even(prob, 0) <> 0) n_nonzero from pred_tok group by feature_num""")
def nonzero_outputs(fx):
    return fx.pred_tok.groupBy("feature_num").agg(
        F.count(F.when(F.bround("prob", 0) != 0, 1)).alias("n_nonzero"))


@query("weighted_mean_loss", """
select event_type run, round(sum(value * (user_id + 1)) / sum(user_id + 1), 6) wmean from events group by event_type""")
def weighted_mean_loss(fx):
    e = fx.t.events
    w = F.col("user_id") + 1
    return e.groupBy(F.col("event_type").alias("run")).agg(
        F.round(F.sum(F.col("value") * w) / F.sum(w), 6).alias("wmean"))


@query("masked_mean_loss", with_ctes("pred_tok") + """
select feature_num, round(avg(-(y * ln(greatest(least(prob, 1 - 1e-7), 1e-7)) + (1 - y) * ln(1 - greatest(least(prob, 1 - 1e-7), 1e-7)))), 6) loss
from (select *, case when tok_no = 1 then -1 else label end y from pred_tok) where y <> -1 group by feature_num""")
def masked_mean_loss(fx):
    p = fx.pred_tok.withColumn("y", F.when(F.col("tok_no") == 1, -1).otherwise(F.col("label")))
    return p.groupBy("feature_num").agg(
        F.round(F.avg(F.when(F.col("y") != -1, bce("prob", "y"))), 6).alias("loss"))


@query("neg_pos_ratio", with_ctes("pred_tok") + """
select round(sum(1 - label) / sum(label), 6) ratio from pred_tok""")
def neg_pos_ratio(fx):
    return fx.token_pairs.agg(F.round(F.sum(1 - F.col("label")) / F.sum("label"), 6).alias("ratio"))


@query("neg_pos_ratio_rowmean", with_ctes("pred_tok") + """
select round(avg(r), 6) ratio, count(*) n_rows from (
  select sum(1 - label) / sum(label) r from pred_tok group by pn_num, feature_num having sum(label) > 0)""")
def neg_pos_ratio_rowmean(fx):
    per = fx.token_pairs.groupBy(*ROW).agg((F.sum(1 - F.col("label")) / F.sum("label")).alias("r"),
                                        F.sum("label").alias("_p")).filter(F.col("_p") > 0)
    return per.agg(F.round(F.avg("r"), 6).alias("ratio"), F.count(F.lit(1)).alias("n_rows"))


@query("accuracy", with_ctes("pred_tok") + """
select round(avg(case when (prob >= 0.5)::int = label then 1.0 else 0.0 end), 6) accuracy, count(*) n from pred_tok""")
def accuracy(fx):
    hit = F.when(F.when(F.col("prob") >= 0.5, 1).otherwise(0) == F.col("label"), 1.0).otherwise(0.0)
    return fx.pred_tok.agg(F.round(F.avg(hit), 6).alias("accuracy"), F.count(F.lit(1)).alias("n"))


@query("exact_sequence_match", with_ctes("pred_tok") + """
select count(*) n_rows, count(*) filter (where ok) n_exact from (
  select bool_and((prob >= 0.5)::int = label) ok from pred_tok group by pn_num, feature_num)""")
def exact_sequence_match(fx):
    per = fx.pred_tok.groupBy(*ROW).agg(F.min(F.when(F.col("prob") >= 0.5, 1).otherwise(0) == F.col("label")).alias("ok"))
    return per.agg(F.count(F.lit(1)).alias("n_rows"), F.count(F.when(F.col("ok"), 1)).alias("n_exact"))


RANKED_SQL = """select vec_id, label, cls, row_number() over (partition by vec_id order by score desc, cls) rk from class_scores"""


def _ranked(fx):
    """(vec_id, label, ranked): classes of a row by score, ties by class; no shuffle."""
    order = F.sort_array(F.transform("scores", lambda x: F.struct((-x["score"]).alias("neg"), x["cls"].alias("cls"))))
    return fx.class_scores.select("vec_id", "label", F.transform(order, lambda x: x["cls"]).alias("ranked"))


def _in_top(k):
    return F.array_contains(F.slice("ranked", 1, k), F.col("label"))


@query("topk_accuracy", with_ctes("class_scores", extra=[("r", RANKED_SQL)]) + """
select round(avg(top1), 6) top1_acc, round(avg(top3), 6) top3_acc from (
  select vec_id, max(case when rk = 1 and cls = label then 1.0 else 0.0 end) top1,
    max(case when rk <= 3 and cls = label then 1.0 else 0.0 end) top3 from r group by vec_id)""")
def topk_accuracy(fx):
    acc = lambda k: F.round(F.avg(F.when(_in_top(k), 1.0).otherwise(0.0)), 6)
    return _ranked(fx).agg(acc(1).alias("top1_acc"), acc(3).alias("top3_acc"))


@query("per_class_accuracy", with_ctes("class_scores", extra=[("r", RANKED_SQL)]) + """
select label, round(avg(case when cls = label then 1.0 else 0.0 end), 6) accuracy, count(*) n from r where rk = 1 group by label""")
def per_class_accuracy(fx):
    return _ranked(fx).groupBy("label").agg(
        F.round(F.avg(F.when(_in_top(1), 1.0).otherwise(0.0)), 6).alias("accuracy"), F.count(F.lit(1)).alias("n"))


@query("topk_classes", with_ctes("class_scores", extra=[("r", RANKED_SQL)]) + """
select vec_id, rk, cls from r where rk <= 3""")
def topk_classes(fx):
    top = _ranked(fx).select("vec_id", F.posexplode(F.slice("ranked", 1, 3)).alias("r", "cls"))
    return top.select("vec_id", (F.col("r") + 1).alias("rk"), "cls")


@query("argmax_class", with_ctes("class_scores", extra=[("r", RANKED_SQL)]) + """
select vec_id, cls pred from r where rk = 1""")
def argmax_class(fx):
    return _ranked(fx).select("vec_id", F.col("ranked")[0].alias("pred"))


@query("misclassified_rows", with_ctes("class_scores", extra=[("r", RANKED_SQL)]) + """
select vec_id, label from r group by vec_id, label having max(case when rk <= 3 and cls = label then 1 else 0 end) = 0""")
def misclassified_rows(fx):
    return _ranked(fx).filter(~_in_top(3)).select("vec_id", "label")


@query("softmax_probs", with_ctes("class_scores", extra=[("sm", """select vec_id, label, cls, ex / sum(ex) over (partition by vec_id) prob from (
       select *, exp(score - max(score) over (partition by vec_id)) ex from class_scores)""")]) + """
select vec_id, cls, round(prob, 6) prob, round(ln(prob), 6) log_prob from sm""")
def softmax_probs(fx):
    sm = _softmax_long(fx)
    return sm.select("vec_id", "cls", F.round("prob", 6).alias("prob"), F.round(F.ln("prob"), 6).alias("log_prob"))


@query("best_epoch_per_fold", with_ctes("series") + """
select run, arg_max(step, (loss, -step)) best_epoch, round(max(loss), 6) best_score from series group by run""")
def best_epoch_per_fold(fx):
    s = fx.series
    best = s.groupBy("run").agg(F.max(F.struct("loss", (-F.col("step")).alias("neg"))).alias("b"))
    return best.select("run", (-F.col("b.neg")).alias("best_epoch"), F.round("b.loss", 6).alias("best_score"))


@query("histogram_bins", """
with v as (select unnest(embedding)::double x from embeddings),
     mm as (select min(x) mn, max(x) mx from v)
select least(floor((x - mn) / (mx - mn) * 200), 199)::int bin, count(*) n from v, mm group by bin""")
def histogram_bins(fx):
    from ...operators.tabular import fit_min_max

    v = fx.t.embeddings.select(F.explode("embedding").alias("x")).select(F.col("x").cast("double").alias("x"))
    mn, mx = fit_min_max(v, "x")
    b = F.least(F.floor((F.col("x") - F.lit(mn)) / F.lit(mx - mn) * 200), F.lit(199)).cast("int")
    return v.groupBy(b.alias("bin")).agg(F.count(F.lit(1)).alias("n"))
