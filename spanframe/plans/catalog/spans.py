"""Span algebra: parse dialects, formatting, labelling rules, decoders.

SURVEY 2.6 (E13-E28), 2.3 (C6-C10, C16), 1.3.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ...functions import spans as S
from ...functions.numeric import rounded
from ...functions.text import clean_spaces
from ...operators import decode as D
from ...operators import labels as L
from ...operators import packed as PK
from ..oracle_sql import with_ctes
from ..registry import query

ROW = ["pn_num", "feature_num"]


def _explode_spans(df, col, key="id"):
    return df.select(key, F.posexplode(col).alias("k0", "sp")).select(
        key, (F.col("k0") + 1).alias("k"), F.col("sp.start").alias("rs"), F.col("sp.end").alias("re"))


# ---- E21: five parse dialects ---------------------------------------------

@query("parse_loc_strip_split", with_ctes("pieces") + "select id, k, rs, re from pieces")
def parse_loc_strip_split(fx):
    return _explode_spans(fx.train, S.parse_loc_strip_split("location"))


@query("parse_loc_sorted", with_ctes("pieces") + """
select id, row_number() over (partition by id order by rs, k) k, rs, re from pieces""")
def parse_loc_sorted(fx):
    return _explode_spans(fx.train, S.parse_loc_sorted("location"))


LIT_UNNEST = """select id, i, unnest(string_split(el, ';')) piece, unnest(range(1, len(string_split(el, ';')) + 1)) j from (
  select id, unnest(a) el, unnest(range(1, len(a) + 1)) i from (
    select id, cast(replace(location, '''', '"') as varchar[]) a from train))"""


@query("parse_loc_literal", with_ctes("train", extra=[("lit", LIT_UNNEST)]) + """
select id, row_number() over (partition by id order by i, j) k,
  split_part(piece, ' ', 1)::int rs, split_part(piece, ' ', 2)::int re from lit""")
def parse_loc_literal(fx):
    return _explode_spans(fx.train, S.parse_loc_literal("location"))


@query("parse_loc_scoring", with_ctes("train") + """
select id, k, regexp_split_to_array(trim(p), '\\s+')[1]::int rs, regexp_split_to_array(trim(p), '\\s+')[2]::int re from (
  select id, unnest(ps) p, unnest(range(1, len(ps) + 1)) k from (
    select id, list_filter(string_split(array_to_string(cast(replace(location, '''', '"') as varchar[]), ';'), ';'),
      lambda x: x <> '') ps from train))""")
def parse_loc_scoring(fx):
    return _explode_spans(fx.train, S.parse_loc_scoring("location"))


def _pred_string(c):
    return F.replace(F.translate(F.col(c), "[]'", ""), F.lit(", "), F.lit(";"))


@query("parse_loc_prediction", with_ctes("train") + """
select id, k, regexp_split_to_array(trim(p), '\\s+')[1]::int rs, regexp_split_to_array(trim(p), '\\s+')[2]::int re from (
  select id, unnest(ps) p, unnest(range(1, len(ps) + 1)) k from (
    select id, list_filter(string_split(replace(translate(location, '[]''', ''), ', ', ';'), ';'),
      lambda x: trim(x) <> '') ps from train where replace(translate(location, '[]''', ''), ', ', ';') <> ''))""")
def parse_loc_prediction(fx):
    return _explode_spans(fx.train, S.parse_loc_prediction(_pred_string("location")))


# ---- E22/E23/F4: formatting and literal lists ------------------------------

@query("format_spans", with_ctes("train", "pieces") + """
select t.id, coalesce(string_agg(p.rs || ' ' || p.re, ';' order by p.k), '') location_fmt,
  coalesce(string_agg(p.rs || ' ' || p.re, '; ' order by p.k), '') location_fmt_blank
from train t left join pieces p using (id) group by t.id""")
def format_spans(fx):
    t = fx.train_spans
    return t.select("id", S.format_spans("spans").alias("location_fmt"),
                    S.format_spans("spans", "; ").alias("location_fmt_blank"))


@query("parse_annotation_list", with_ctes("train") + """
select id, unnest(range(1, len(a) + 1)) k, unnest(a) annotation from (
  select id, cast(replace(annotation, '''', '"') as varchar[]) a from train)""")
def parse_annotation_list(fx):
    return fx.train.select("id", F.posexplode(S.parse_string_list("annotation")).alias("k0", "annotation")) \
        .select("id", (F.col("k0") + 1).alias("k"), "annotation")


@query("sort_spans", with_ctes("train", "pieces") + """
select t.id, coalesce(string_agg(p.rs || ' ' || p.re, ';' order by p.rs, p.k), '') sorted_location
from train t left join pieces p using (id) group by t.id""")
def sort_spans(fx):
    return fx.train.select("id", S.format_spans(S.parse_loc_sorted("location")).alias("sorted_location"))


@query("spans_to_mask", with_ctes("pieces") + """
select id, min(c)::int start, (max(c) + 1)::int "end" from (
  select id, c, c - row_number() over (partition by id order by c) g from (
    select distinct id, unnest(range(rs, re)) c from pieces)) group by id, g""")
def spans_to_mask(fx):
    """The binary char mask of each row, run-length coded as its maximal
    marked intervals (overlapping or abutting spans merge)."""
    r = fx.rows_with_spans.select("id", F.explode("spans").alias("sp")) \
        .select("id", F.col("sp.start").alias("s"), F.col("sp.end").alias("e")).filter(F.col("e") > F.col("s"))
    return D.char_runs(r, ["id"]).select("id", "start", "end")


@query("entities_per_note", with_ctes("pieces") + """
select pn_num, row_number() over (partition by pn_num order by rs, re, feature_num) rank, rs start, re "end", feature_num
from pieces""")
def entities_per_note(fx):
    r = fx.rows_with_spans.select("pn_num", "feature_num", F.explode("spans").alias("sp"))
    ents = r.groupBy("pn_num").agg(F.sort_array(F.collect_list(F.struct(
        F.col("sp.start").alias("start"), F.col("sp.end").alias("end"), "feature_num"))).alias("ents"))
    return ents.select("pn_num", F.posexplode("ents").alias("r0", "x")).select(
        "pn_num", (F.col("r0") + 1).alias("rank"), "x.start", "x.end", "x.feature_num")


@query("offsets_flatten_restore", with_ctes("tokens") + """
select pn_num, (2 * count(*))::int n_flat, true ok from tokens group by pn_num""")
def offsets_flatten_restore(fx):
    n = fx.note_tok_arrays.filter(F.size("toks") > 0)
    flat = F.flatten(F.transform("toks", lambda t: F.array(t["s"], t["e"])))
    n = n.withColumn("flat", flat)
    restored = F.transform(F.sequence(F.lit(0), (F.size("flat") / 2).cast("int") - 1),
                           lambda i: F.struct(F.element_at("flat", (2 * i + 1).cast("int")).alias("s"),
                                              F.element_at("flat", (2 * i + 2).cast("int")).alias("e")))
    return n.select("pn_num", F.size("flat").alias("n_flat"), (restored == F.col("toks")).alias("ok"))


# ---- C6-C10: labelling rules ----------------------------------------------

@query("label_overlap90", with_ctes("pieces", "tokens") + """
select p.id, t.tok_no, max(case when greatest(least(t.e, p.re) + 1 - greatest(t.s, p.rs), 0) / (t.e + 1 - t.s) > 0.9
  then 1 else 0 end) score from pieces p join tokens t using (pn_num) group by p.id, t.tok_no""")
def label_overlap90(fx):
    return L.label_overlap90(fx.packed_with_spans)


@query("label_overlap90_per_span", with_ctes("pieces", "tokens") + """
select p.id, t.tok_no, p.k, case when greatest(least(t.e, p.re) + 1 - greatest(t.s, p.rs), 0) / (t.e + 1 - t.s) > 0.9
  then 1 else 0 end score from pieces p join tokens t using (pn_num)""")
def label_overlap90_per_span(fx):
    return L.label_overlap90_per_span(fx.packed_with_spans)


@query("label_containment", with_ctes("pieces", "tokens") + """
select p.id, t.tok_no, max(case when t.s >= p.rs and t.e <= p.re then 1 else 0 end) label
from pieces p join tokens t using (pn_num) group by p.id, t.tok_no""")
def label_containment(fx):
    return L.label_containment(fx.packed_with_spans)


POS_SQL = """select pn_num, tok_no::int p, s ts, e te from tokens
  union all select pn_num, 0, 0, 0 from notes
  union all select pn_num, (max(tok_no) + 1)::int, 0, 0 from tokens group by pn_num"""


@query("label_boundary", with_ctes("pieces", "tokens", "notes", extra=[("pos", POS_SQL)]) + """
, b as (select pc.id, pc.pn_num, pc.k, min(case when ts > pc.rs then pos.p end) - 1 st,
          min(case when te >= pc.re then pos.p end) + 1 en from pieces pc join pos using (pn_num) group by pc.id, pc.pn_num, pc.k),
  c as (select *, coalesce(st, en) st2 from b where en is not null)
select distinct c.id, pos.p from c join pos on pos.pn_num = c.pn_num and pos.p >= c.st2 and pos.p < c.en""")
def label_boundary(fx):
    return L.label_boundary(fx.packed_with_spans)


CLASS_SQL = """select * from (select *, max(label) over (partition by pn_num) m from (
  select t.pn_num, t.tok_no, t.s, t.e, coalesce(max(p.feature_num) filter (where t.s < t.e and t.s >= p.rs and t.e <= p.re) + 1, 0)::bigint label
  from tokens t join pieces p on p.pn_num = t.pn_num group by t.pn_num, t.tok_no, t.s, t.e)) where m > 0"""


@query("label_feature_class", with_ctes("pieces", "tokens", extra=[("cls", CLASS_SQL)]) + """
select pn_num, tok_no, label from cls""")
def label_feature_class(fx):
    return L.label_feature_class(fx.packed_with_spans).select("pn_num", "tok_no", "label")


# ---- E8, E16-E19: decoders --------------------------------------------------

@query("islands_runs", with_ctes("pred_tok") + """
select pn_num, feature_num, min(tok_no) "first", max(tok_no) "last", count(*) n from (
  select *, tok_no - row_number() over (partition by pn_num, feature_num order by tok_no) g from pred_tok where prob >= 0.5)
group by pn_num, feature_num, g""")
def islands_runs(fx):
    r = PK.token_runs(fx.scored, lambda x: x["prob"] >= 0.5, "runs").select(*ROW, PK.each("runs").alias("r")).filter("r is not null")
    return r.select(*ROW, F.col("r.first_tok").alias("first"), F.col("r.last_tok").alias("last"),
                    (F.col("r.last_tok") - F.col("r.first_tok") + 1).cast("long").alias("n"))


def _char_runs_sql(cond, fmt):
    return with_ctes("pred_tok", extra=[
        ("ch", f"select distinct pn_num, feature_num, unnest(range(s, e)) c from pred_tok where {cond}"),
        ("runs", """select pn_num, feature_num, min(c) a, max(c) b from (
           select *, c - row_number() over (partition by pn_num, feature_num order by c) g from ch)
           group by pn_num, feature_num, g"""),
        ("rws", "select distinct pn_num, feature_num from pred_tok")]) + f"""
select r.pn_num, r.feature_num, coalesce(string_agg({fmt}, ';' order by a), '') location
from rws r left join runs using (pn_num, feature_num) group by r.pn_num, r.feature_num"""


@query("decode_runs_shift1", _char_runs_sql("prob >= 0.5", "(a + 1) || ' ' || (b + 1)"))
def decode_runs_shift1(fx):
    return PK.decode_chars(fx.scored, lambda x: x["prob"] >= 0.5, start=1).select(*ROW, "location")


@query("decode_runs_exact", _char_runs_sql("label > 0", "a || ' ' || (b + 1)"))
def decode_runs_exact(fx):
    return PK.decode_chars(fx.scored, lambda x: x["label"] > 0).select(*ROW, "location")


@query("runs_transition", with_ctes("pred_tok", "notes", extra=[
    ("ch", "select distinct pn_num, feature_num, unnest(range(s, e)) c from pred_tok where prob >= 0.5"),
    ("runs", """select pn_num, feature_num, min(c) a, max(c) b from (
       select *, c - row_number() over (partition by pn_num, feature_num order by c) g from ch)
       group by pn_num, feature_num, g""")]) + """
select r.pn_num, r.feature_num, r.a::int start, (r.b + 1)::int "end" from runs r join notes n using (pn_num)
where r.b + 1 < length(n.pn_history)""")
def runs_transition(fx):
    """Runs closed by a following char: one that touches the end of the text is never emitted."""
    r = PK.char_runs(fx.scored, lambda x: x["prob"] >= 0.5, "runs").select(*ROW, PK.each("runs").alias("r")).filter("r is not null")
    tl = fx.notes.select("pn_num", F.length("pn_history").alias("text_len"))
    return r.join(tl, "pn_num").filter(F.col("r.end") < F.col("text_len")).select(*ROW, "r.start", "r.end")


TOKEN_RUNS_SQL = with_ctes("pred_tok", extra=[
    ("runs", """select pn_num, feature_num, min(s) a, max(e) b, min(tok_no) ft, max(tok_no) lt from (
       select *, tok_no - row_number() over (partition by pn_num, feature_num order by tok_no) g from pred_tok where prob > 0.5)
       group by pn_num, feature_num, g"""),
    ("rws", "select pn_num, feature_num, max(tok_no) last_tok from pred_tok group by pn_num, feature_num"),
    ("r2", """select r.*, w.last_tok, max(case when a = 0 then 1 else 0 end) over (partition by r.pn_num, r.feature_num
       order by ft rows between unbounded preceding and current row) zs from runs r join rws w using (pn_num, feature_num)""")]) + """
select w.pn_num, w.feature_num,
  coalesce((select string_agg(a || ' ' || b, ';' order by a) from runs x
            where x.pn_num = w.pn_num and x.feature_num = w.feature_num), '') flush,
  coalesce((select string_agg(a || ' ' || b, '; ' order by a) from r2 x
            where x.pn_num = w.pn_num and x.feature_num = w.feature_num and x.lt < x.last_tok
              and x.a <> 0 and x.b <> 0 and x.zs = 0), '') noflush
from rws w"""


@query("decode_token_runs", TOKEN_RUNS_SQL)
def decode_token_runs(fx):
    return PK.decode_tokens(fx.scored, th=0.5).select(*ROW, "flush", "noflush")


@query("decode_class_runs", with_ctes("pieces", "tokens", "train", extra=[
    ("cls", CLASS_SQL),
    ("cruns", """select pn_num, label, min(s) a, max(e) b from (
       select *, tok_no - row_number() over (partition by pn_num, label order by tok_no) g from cls where label > 0)
       group by pn_num, label, g""")]) + """
select t.id, coalesce(string_agg(c.a || ' ' || c.b, ';' order by c.a), '') location
from train t left join cruns c on c.pn_num = t.pn_num and c.label = t.feature_num + 1 group by t.id""")
def decode_class_runs(fx):
    tc = L.label_feature_class(fx.packed_with_spans)
    runs = D.class_runs(tc)
    req = fx.train.select("id", "pn_num", (F.col("feature_num") + 1).alias("label"))
    asked = runs.join(req.select("pn_num", "label").distinct(), ["pn_num", "label"], "left_semi")
    per_id = req.join(asked, ["pn_num", "label"])
    loc = D.format_runs(per_id, ["id"])
    return req.select("id").join(loc, "id", "left").select("id", F.coalesce("location", F.lit("")).alias("location"))


# ---- E14, E15, E20: char-level projections ---------------------------------

CHAR_WIN = [("cw", """select pn_num, feature_num, c, arg_max(prob, tok_no) p, max(tok_no) w, arg_max(s, tok_no) ws from (
   select pn_num, feature_num, tok_no, s, prob, unnest(range(s, e)) c from pred_tok) group by pn_num, feature_num, c""")]


@query("char_probs", with_ctes("pred_tok", extra=CHAR_WIN) + """
select pn_num, feature_num, min(c)::int start, (max(c) + 1)::int "end", min(p) p from cw group by pn_num, feature_num, w""")
def char_probs(fx):
    return D.paint_probs(fx.scored, ROW)


@query("char_pred_3class", with_ctes("pred_tok", extra=CHAR_WIN) + """
select pn_num, feature_num, min(c)::int start, (max(c) + 1)::int "end", round(1 - min(p), 6) p0,
  round(case when min(c) = min(ws) then 0.3 * min(p) else greatest(0.3 * min(p), 0.7 * min(p)) end, 6) p1,
  round(case when min(c) = min(ws) then 0.7 * min(p) else least(0.3 * min(p), 0.7 * min(p)) end, 6) p2
from cw group by pn_num, feature_num, w, (c = ws)""")
def char_pred_3class(fx):
    out = D.paint_3class(fx.packed_with_words, ROW, lambda p: (1 - p, 0.3 * p, 0.7 * p), scored=fx.scored_items)
    return out.select(*ROW, "start", "end", *[rounded(c).alias(c) for c in ("p0", "p1", "p2")])


@query("postprocess_spaces", with_ctes("pred_tok", "notes", extra=[
    ("ch", "select distinct pn_num, feature_num, unnest(range(s, e)) c from pred_tok where prob >= 0.5"),
    ("runs", """select pn_num, feature_num, min(c) a, max(c) + 1 b from (
       select *, c - row_number() over (partition by pn_num, feature_num order by c) g from ch)
       group by pn_num, feature_num, g"""),
    ("j", """select r.*, translate(n.pn_history, chr(10) || chr(9) || chr(13), '   ') clean
       from runs r join notes n using (pn_num)"""),
    ("m", """select *, case when lag(b) over (partition by pn_num, feature_num order by a) = a - 1
       and substr(clean, a, 1) = ' ' then 0 else 1 end nw from j"""),
    ("g", """select *, sum(nw) over (partition by pn_num, feature_num order by a rows between unbounded preceding
       and current row) grp from m""")]) + """
select w.pn_num, w.feature_num, coalesce(l.location, '') location from (select distinct pn_num, feature_num from pred_tok) w
left join (select pn_num, feature_num, string_agg(s || ' ' || e, ';' order by s) location from (
  select pn_num, feature_num, min(a) s, max(b) e from g group by pn_num, feature_num, grp)
  group by pn_num, feature_num) l using (pn_num, feature_num)""")
def postprocess_spaces(fx):
    runs = PK.char_runs(fx.scored_by_batch, lambda x: x["prob"] >= 0.5, "runs").select(*ROW, "runs")
    texts = fx.notes.select("pn_num", clean_spaces("pn_history").alias("clean"))
    j = D.clean_blank_edges(runs.join(texts, "pn_num"), "clean", "runs", "pp")
    return j.select(*ROW, S.format_spans("pp").alias("location"))
