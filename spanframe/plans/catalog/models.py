"""Model jobs and the streaming smoke."""

from __future__ import annotations

from pyspark.sql import functions as F

from ...operators import folds as FO
from ...operators import metrics as M
from ...operators import models as MD
from ...sources import files as FS
from ...streaming import decode as SD
from ...streaming.parse_join import run_available_now
from ..fixtures import annotate
from ..oracle_sql import with_ctes
from ..registry import query
from ..strategy import checkpoint_table
from .metrics import FOLDS_SQL
from .vocab import OOV, STOP, VOCAB_CTES
from .vocab import _vocab as vocabulary

ROW = ["pn_num", "feature_num"]


@query("tabular_mlp_predictions")
def tabular_mlp_predictions(fx):
    p = FO.split_hash(fx.passengers, "pid", 80)
    out = MD.tabular_mlp(p.filter(F.col("part") == "train"), p.filter(F.col("part") == "valid"),
                         "survived", ["age", "nationkey"], ["segment"])
    return out.select("pid", "survived", F.col("prediction").cast("int").alias("prediction"))


@query("text_classifier_predictions")
def text_classifier_predictions(fx):
    t = FO.split_hash(fx.tweets, "doc_id", 80)
    out = MD.text_classifier(t.filter(F.col("part") == "train"), t.filter(F.col("part") == "valid"), "text", "label")
    return out.select("doc_id", "label", F.col("prediction").cast("int").alias("prediction"))


SCORER_SQL = "1.0 / (1.0 + exp(-((e - s)::double - 5.0)))"


@query("batch_score_tokens", with_ctes("pred_tok") + f"""
select pn_num, feature_num, tok_no, s, e, round({SCORER_SQL}, 6) prob from pred_tok""")
def batch_score_tokens(fx):
    scored = MD.batch_score(annotate(fx.packed, fx.features).select(*ROW, "s", "e"))
    # an outer explode: for a plain one the scores would be made a second time, in a filter on their number
    t = scored.select(*ROW, F.posexplode_outer(F.arrays_zip("s", "e", "probs")).alias("i", "t")).filter(F.col("i").isNotNull())
    return t.select(*ROW, (F.col("i") + 1).alias("tok_no"), "t.s", "t.e", F.round("t.probs", 6).alias("prob"))


@query("cv_oof_scores", with_ctes("pred_tok", "pieces", "train", extra=[
    ("pc", f"select distinct pn_num, feature_num, unnest(range(s, e)) c from pred_tok where {SCORER_SQL} >= 0.5"),
    ("tc", "select distinct pn_num, feature_num, unnest(range(rs, re)) c from pieces"),
    ("cj", """select coalesce(p.pn_num, t.pn_num) pn_num, (p.c is not null) ip, (t.c is not null) it
       from pc p full outer join tc t on p.pn_num = t.pn_num and p.feature_num = t.feature_num and p.c = t.c"""),
    ("fo", FOLDS_SQL)]) + """
select fold, tp, fp, fn, round(case when 2 * tp + fp + fn > 0 then 2.0 * tp / (2 * tp + fp + fn) else 0 end, 6) f1 from (
  select fo.fold, count(*) filter (where ip and it) tp, count(*) filter (where ip and not it) fp,
         count(*) filter (where it and not ip) fn from cj join fo using (pn_num) group by rollup(fo.fold))""")
def cv_oof_scores(fx):
    """Deterministic scorer: one pass with a fold column instead of a loop of
    five fits; per-fold and overall scores from one rollup."""
    scored = MD.batch_score(fx.annotated_rows)
    tokens = F.arrays_zip(F.col("s").alias("start"), F.col("e").alias("end"), F.col("probs").alias("prob"))
    rows = scored.select(*ROW, "spans", F.filter(tokens, lambda x: x["prob"] >= 0.5).alias("pred"))
    counts = M.packed_overlap_counts(rows, "pred", "spans", ROW)
    folds = FO.group_kfold(fx.train.select("pn_num").distinct(), "pn_num", 5)
    return M.micro_f1_rollup(counts.join(folds, "pn_num"), "fold")


FOLDS = 5
MARKS = ["same_length", "same_first", "same_last"]

CV_CTES = [
    ("fo", FOLDS_SQL),
    ("tp", """select n.pn_num, f.feature_num, t.tok_no, fo.fold, (t.token = f.term)::int "label",
       (length(t.token) = length(f.term))::int x0, (substr(t.token, 1, 1) = substr(f.term, 1, 1))::int x1,
       (right(t.token, 1) = right(f.term, 1))::int x2
     from notes n join features f on n.case_num = f.case_num join tokens t using (pn_num) join fo using (pn_num)"""),
    ("cell", 'select fold, "label", count(*) n, sum(x0) c0, sum(x1) c1, sum(x2) c2 from tp group by fold, "label"'),
    ("fit", """select k.fold, c."label" y, sum(n) n, ln(sum(n) + 1.0) pi, (sum(c0) + 1.0) / (sum(n) + 2) p0,
       (sum(c1) + 1.0) / (sum(n) + 2) p1, (sum(c2) + 1.0) / (sum(n) + 2) p2
     from (select distinct fold from cell) k join cell c on c.fold <> k.fold group by k.fold, c."label" """),
    ("raw", """select tp.*, y, pi + ln(case when x0 = 1 then p0 else 1 - p0 end) + ln(case when x1 = 1 then p1 else 1 - p1 end)
       + ln(case when x2 = 1 then p2 else 1 - p2 end) r from tp join fit using (fold)"""),
]


@query("cv_oof_model", with_ctes("tokens", "train", extra=CV_CTES) + """
select pn_num, feature_num, tok_no, fold, any_value("label") "label", false leaked,
  round(1 / (1 + exp(max(r) filter (where y = 0) - max(r) filter (where y = 1))), 6) prob
from raw group by pn_num, feature_num, tok_no, fold""")
def cv_oof_model(fx):
    """Cross-validation with a fit per fold: naive Bayes on three marks of a
    (token, term) pair, fitted on the other folds' pairs, scores the fold.
    Training reads counts of equal pairs, and the models score each kind of pair
    (fold, label, marks: at most 16 a fold) once; every pair takes the score of
    its kind.  ``leaked`` tells whether a row's model was taught by its fold."""
    folds = FO.group_kfold(fx.train.select("pn_num").distinct(), "pn_num", FOLDS)
    w, t = F.col("word"), F.col("term")
    same = [F.length(w) == F.length(t), F.substring(w, 1, 1) == F.substring(t, 1, 1), F.right(w, F.lit(1)) == F.right(t, F.lit(1))]
    # the fold comes to the note, not to its pairs
    rows = fx.word_pairs_of(fx.packed.join(folds, "pn_num"), "fold").select(
        "pn_num", "feature_num", "tok_no", "fold", "label", *[s.cast("int").alias(m) for s, m in zip(same, MARKS)])
    counts = checkpoint_table(rows.groupBy("fold", "label", *MARKS).agg(F.count(F.lit(1)).alias("n")))
    cells = MD.cross_validated(counts, "fold", lambda d: MD.naive_bayes(d, MARKS), lambda m, d: MD.positive_share(m, d, MARKS),
                               range(FOLDS)).drop("n")
    # a bounded table: without the hint all pairs would be shuffled by their marks
    out = rows.join(F.broadcast(cells), ["fold", "label", *MARKS])
    return out.select("pn_num", "feature_num", "tok_no", "fold", "label",
                      F.array_contains("model_folds", F.col("fold")).alias("leaked"), F.round("prob", 6).alias("prob"))


def _stream(fx, build):
    def notes(stream):
        return build(stream.select(F.col("doc_id").alias("pn_num"), fx.case_of("doc_id").alias("case_num"),
                                   F.col("text").alias("pn_history")))

    out, ck = FS.scratch(fx.spark, "stream-out"), FS.scratch(fx.spark, "stream-ckpt")
    return SD.run_to_parquet(fx.spark, fx.sf_dir, "documents.parquet", fx.t.documents.schema, notes, out, ck)


STREAM_DECODE_SQL = with_ctes("pred_tok", "train", "pieces", "features", extra=[
    ("tr", """select pn_num, feature_num, min(s) a, max(e) b, min(tok_no) ft, max(tok_no) lt from (
       select *, tok_no - row_number() over (partition by pn_num, feature_num order by tok_no) g from pred_tok where prob > 0.5)
       group by pn_num, feature_num, g"""),
    ("w", "select pn_num, feature_num, max(tok_no) last_tok from pred_tok group by pn_num, feature_num"),
    ("tz", """select tr.*, last_tok, max((a = 0)::int) over (partition by pn_num, feature_num order by ft) z
       from tr join w using (pn_num, feature_num)"""),
    ("tl", """select pn_num, feature_num, string_agg(a || ' ' || b, ';' order by a) flush,
       string_agg(a || ' ' || b, '; ' order by a) filter (where lt < last_tok and a <> 0 and b <> 0 and z = 0) noflush
       from tz group by pn_num, feature_num"""),
    *[(f"c{k}", f"""select pn_num, feature_num, string_agg({fmt}, ';' order by a) loc from (
       select pn_num, feature_num, min(c) a, max(c) b from (
         select *, c - row_number() over (partition by pn_num, feature_num order by c) g from (
           select pn_num, feature_num, unnest(range(s, e)) c from pred_tok where {cond}))
       group by pn_num, feature_num, g) group by pn_num, feature_num""")
      for k, cond, fmt in ((1, "prob >= 0.5", "(a + 1) || ' ' || (b + 1)"), (2, '"label" > 0', "a || ' ' || (b + 1)"))],
    ("pl", """select id, count(*)::int n, string_agg(rs || ' ' || re, ';' order by rs, k) srt from pieces group by id"""),
]) + """
select t.id, t.pn_num, t.feature_num,
  replace(replace(replace(f.feature_text, 'I-year', '1-year'), '-OR-', ' or '), '-', ' ') feature_text, t.location,
  coalesce(pl.n, 0)::int n_spans, coalesce(pl.srt, '') sorted_location, coalesce(pl.n, 0)::int n_pieces,
  coalesce(c1.loc, '') runs_shift1, coalesce(c2.loc, '') runs_exact, coalesce(tl.flush, '') flush, coalesce(tl.noflush, '') noflush
from train t join w using (pn_num, feature_num) join features f using (feature_num) left join pl using (id)
left join c1 using (pn_num, feature_num) left join c2 using (pn_num, feature_num) left join tl using (pn_num, feature_num)"""


@query("stream_decode", STREAM_DECODE_SQL)
def stream_decode(fx):
    """Scores decoded by every rule, literals parsed and feature texts normalised on a stream of notes."""
    return _stream(fx, lambda notes: SD.decoded_rows(notes, fx.features))


@query("stream_encode", with_ctes("tokens", "notes", extra=VOCAB_CTES) + f"""
select e.pn_num, e.tok_no, e.idx, list_contains({STOP}, t.token) is_stop,
  (length(pn_history) - length(ltrim(pn_history, chr(10) || chr(9) || chr(13) || ' ')))::int shift,
  length(trim(pn_history, chr(10) || chr(9) || chr(13) || ' '))::int n_clean
from enc e join tokens t using (pn_num, tok_no) join notes using (pn_num)""")
def stream_encode(fx):
    """Cleaned, stripped and stop-word-marked notes as ids of a static vocabulary, on a stream."""
    vocab = checkpoint_table(vocabulary(fx))
    return _stream(fx, lambda notes: SD.encoded_words(notes, vocab, OOV))


@query("stream_parse_join", with_ctes("notes", "features", "tokens") + """
select n.pn_num, f.feature_num, t.s, t.e from notes n join features f on n.case_num = f.case_num
join tokens t on t.pn_num = n.pn_num and t.token = f.term""")
def stream_parse_join(fx):
    schema = fx.t.documents.schema.simpleString().replace("struct<", "").rstrip(">").replace(":", " ")
    out, ck = FS.scratch(fx.spark, "stream-out"), FS.scratch(fx.spark, "stream-ckpt")
    return run_available_now(fx.spark, fx.sf_dir, "documents.parquet", schema, fx.features, fx.case_of, out, ck)
