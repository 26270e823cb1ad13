"""DuckDB twins of the fixture relations, inlined as CTEs in oracle SQL.

``with_ctes("tokens", "train")`` returns ``WITH notes AS (...), ...`` with
all dependencies in order, ready to prefix a ``SELECT``.
"""

from __future__ import annotations

from .fixtures import FEATURES_PER_CASE

# about FEATURES_PER_CASE features share a case, whatever the size of the catalogue
CASES = f"(select greatest(1, count(*) // {FEATURES_PER_CASE}) from benchmark)"

FIXTURE_SQL = {
    "notes": f"select doc_id pn_num, (doc_id % {CASES})::int case_num, text pn_history from documents",
    "features": f"""select item_id feature_num, (item_id % {CASES})::int case_num,
  concat(array_to_string(string_split(text,' ')[1:2],'-'),'-OR-',string_split(text,' ')[3]) feature_text,
  lower(regexp_extract(text, '\\p{{L}}+')) term from benchmark""",
    "tokens": """select pn_num, pos, lower(seg) token, s::int s, (s+length(seg))::int e, row_number() over (partition by pn_num order by pos) tok_no from (
   select *, coalesce(sum(length(seg)) over (partition by pn_num order by pos rows between unbounded preceding and 1 preceding),0) s
   from (select pn_num, unnest(a) seg, (generate_subscripts(a,1)-1)::int pos from (select pn_num, regexp_extract_all(pn_history,'([\\p{L}\\p{N}]+|[^\\p{L}\\p{N}]+)') a from notes)))
   where regexp_matches(seg,'^[\\p{L}\\p{N}]')""",
    "occ": """select n.pn_num, n.case_num, f.feature_num, t.s, t.e, t.token,
      row_number() over (partition by n.pn_num, f.feature_num order by t.s) k
   from notes n join features f on n.case_num=f.case_num join tokens t on t.pn_num=n.pn_num and t.token=f.term""",
    "lits": """select pn_num, feature_num, '[''' || string_agg(a, ''', ''' order by el) || ''']' annotation,
      '[''' || string_agg(l, ''', ''' order by el) || ''']' location from (
     select pn_num, feature_num, (k - 1) // 2 el, string_agg(token, ' ' order by k) a, string_agg(s || ' ' || e, ';' order by k) l
     from occ group by pn_num, feature_num, (k - 1) // 2) group by pn_num, feature_num""",
    "train": """select concat(n.pn_num,'_',f.feature_num) id, n.case_num, n.pn_num, f.feature_num,
   coalesce(l.annotation, '[]') annotation, coalesce(l.location, '[]') location
   from notes n join features f on n.case_num=f.case_num left join lits l on l.pn_num=n.pn_num and l.feature_num=f.feature_num""",
    "pred_tok": """select pn_num, feature_num, tok_no, s, e, label, (450*label + case when h % 1000 < 2 then 549 else h % 450 end)/1000.0::double prob from (
   select t.pn_num, r.feature_num, t.tok_no, t.s, t.e, case when o.s is null then 0 else 1 end as label,
     ('0x'||substr(md5(concat(t.pn_num,'_',r.feature_num,'_',t.tok_no)),1,8))::bigint as h
   from train r join tokens t on t.pn_num=r.pn_num left join occ o on o.pn_num=t.pn_num and o.feature_num=r.feature_num and o.s=t.s)""",
}

FIXTURE_SQL.update({
    "merged": """select * from train left join features using (feature_num, case_num)
   left join notes using (pn_num, case_num)""",
    "passengers": """select c.c_custkey pid, case when c.c_acctbal < 0 then null else c.c_acctbal end age,
   c.c_mktsegment segment, c.c_nationkey nationkey, n.n_name nation,
   case when coalesce(o.n_orders, 0) > 10 then 1 else 0 end survived
   from customer c left join nation n on c.c_nationkey = n.n_nationkey
   left join (select o_custkey, count(*) n_orders from orders group by o_custkey) o on o.o_custkey = c.c_custkey""",
    "series": """select event_type run, event_id, value loss,
   row_number() over (partition by event_type order by event_id) step from events""",
    "class_scores": """with e as (select vec_id, label, unnest(embedding) v, unnest(range(0, len(embedding))) dim from embeddings),
   c as (select label cls, dim, avg(v) cv from e group by label, dim)
   select vec_id, label, cls, sum(v * cv) score from e join c using (dim) group by vec_id, label, cls""",
    "bias_rows": """select l.doc_id, l.toxic::double target,
   0.5 * l.toxic + 0.6 * (('0x' || substr(md5(l.doc_id::varchar), 1, 8))::bigint / 4294967296.0) prediction,
   case when d.lang = 'fr' then 1.0 else 0.0 end::double id_fr,
   case when d.lang = 'de' then 1.0 else 0.0 end::double id_de,
   case when d.lang = 'es' then 1.0 else 0.0 end::double id_es
   from labels l join documents d using (doc_id)""",
    "tweets": """select l.doc_id, d.text, l.quality * 2 + l.toxic label from labels l join documents d using (doc_id)""",
})

DEPS = {
    "notes": [],
    "features": [],
    "tokens": ["notes"],
    "occ": ["notes", "features", "tokens"],
    "lits": ["occ"],
    "train": ["notes", "features", "lits"],
    "pred_tok": ["train", "tokens", "occ"],
    "merged": ["train", "features", "notes"],
    "pieces": ["train"],
}

FIXTURE_SQL["pieces"] = """select id, pn_num, feature_num, k, split_part(trim(x), ' ', 1)::int rs, split_part(trim(x), ' ', 2)::int re from (
   select id, pn_num, feature_num, unnest(p) x, unnest(range(1, len(p) + 1)) k from (
     select id, pn_num, feature_num,
       list_filter(string_split_regex(translate(location, '[]''', ''), '[,;]'), lambda x: trim(x) <> '') p
     from train))"""


def _order(names):
    out = []

    def visit(n):
        for d in DEPS.get(n, []):
            visit(d)
        if n not in out:
            out.append(n)

    for n in names:
        visit(n)
    return out


def with_ctes(*names: str, extra: list[tuple[str, str]] | None = None) -> str:
    """WITH-clause for fixture relations plus extra (name, sql) CTEs."""
    parts = [f"{n} AS MATERIALIZED ({FIXTURE_SQL[n]})" for n in _order(names)]
    parts += [f"{n} AS MATERIALIZED ({q})" for n, q in (extra or [])]
    return ("WITH " + ",\n".join(parts) + "\n") if parts else ""
