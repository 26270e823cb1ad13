"""Tokens, vocabularies and id encodings (SURVEY D7, D8, E11, E11b, F1, C11,
C13, C18, C19, E24-E27, H5-H7, A9)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ...functions.stopwords import sql_list
from ...functions.text import norm_feature_text
from ...operators import vocab as V
from ...session import ensure_checkpoint_dir
from ...sources import files as FS
from ..fixtures import tokens_of
from ..oracle_sql import with_ctes
from ..registry import query
from ..strategy import checkpoint_table

K = 5000
OOV = K
MAX_LEN = 300  # the width of a truncated pair
WORD = r"[\p{L}\p{N}]+"
STOP = sql_list()

VOCAB_CTES = [
    ("wf", f"select token, count(*) cnt from tokens where not list_contains({STOP}, token) group by token"),
    ("vk", f"""select token, cnt, (row_number() over (order by cnt desc, token) - 1)::int idx from (
       select * from wf order by cnt desc, token limit {K})"""),
    ("enc", f"select t.pn_num, t.tok_no, coalesce(v.idx, {OOV})::int idx from tokens t left join vk v using (token)"),
]


def _vocab(fx):
    return V.top_k(V.word_freq(fx.tokens), K)


def encoded_tokens(fx):
    return V.encode(fx.tokens.select("pn_num", "tok_no", "token"), _vocab(fx), OOV) \
        .withColumn("tid", F.col("idx") + V.ID_SHIFT)


@query("word_freq", with_ctes("tokens", extra=VOCAB_CTES[:1]) + "select token, cnt from wf")
def word_freq(fx):
    return V.word_freq(fx.tokens)


@query("tokenize_filter", with_ctes("tokens") + f"""
select pn_num, tok_no, token from tokens where not list_contains({STOP}, token)""")
def tokenize_filter(fx):
    return V.drop_stop_words(fx.tokens).select("pn_num", "tok_no", "token")


@query("max_token_length", with_ctes("notes", "features") + f"""
select max_note, max_feature, max_note + max_feature + 3 max_len from
  (select max(len(regexp_extract_all(pn_history, '{WORD}'))) max_note from notes),
  (select max(len(regexp_extract_all(replace(replace(replace(feature_text, 'I-year', '1-year'), '-OR-', ' or '), '-', ' '),
     '{WORD}'))) max_feature from features)""")
def max_token_length(fx):
    n = fx.notes.select(F.lit("note").alias("kind"), F.regexp_count("pn_history", F.lit(WORD)).alias("n"))
    f = fx.features.select(F.lit("feature").alias("kind"),
                           F.regexp_count(norm_feature_text("feature_text"), F.lit(WORD)).alias("n"))
    m = n.unionByName(f).agg(
        F.max(F.when(F.col("kind") == "note", F.col("n"))).cast("long").alias("max_note"),
        F.max(F.when(F.col("kind") == "feature", F.col("n"))).cast("long").alias("max_feature"))
    return m.select("max_note", "max_feature", (F.col("max_note") + F.col("max_feature") + 3).alias("max_len"))


@query("vocab_topk", with_ctes("tokens", extra=VOCAB_CTES[:2]) + "select token, cnt, idx from vk")
def vocab_topk(fx):
    return _vocab(fx)


@query("topk_words", with_ctes("tokens", extra=VOCAB_CTES[:1]) + """
select token, cnt from wf order by cnt desc, token limit 10""")
def topk_words(fx):
    return V.word_freq(fx.tokens).orderBy(F.desc("cnt"), "token").limit(10)


FIRST_SEEN = """select token, (row_number() over (order by pn_num, pos) - 1) idx from (
  select token, pn_num, pos, row_number() over (partition by token order by pn_num, pos) r from tokens) where r = 1"""


@query("vocab_first_seen", with_ctes("tokens") + FIRST_SEEN)
def vocab_first_seen(fx):
    return V.first_seen_index(fx.tokens)


@query("encode_vocab", with_ctes("tokens", extra=VOCAB_CTES) + "select pn_num, tok_no, idx from enc")
def encode_vocab(fx):
    return encoded_tokens(fx).select("pn_num", "tok_no", "idx")


@query("encode_vocab_strict", with_ctes("tokens", extra=[("fs", FIRST_SEEN)]) + """
select count(*) n_tokens, count(fs.idx) n_encoded, count(*) - count(fs.idx) n_lost
from tokens t left join fs using (token)""")
def encode_vocab_strict(fx):
    full = V.first_seen_index(fx.tokens)
    words = fx.tokens.groupBy("token").agg(F.count(F.lit(1)).alias("n"))  # one row a word before the lookup
    j = V.encode_strict(words, full)  # fails on a word without an index
    known = F.coalesce(F.sum(F.when(F.col("idx").isNotNull(), F.col("n"))), F.lit(0))
    total = F.coalesce(F.sum("n"), F.lit(0))
    return j.agg(total.alias("n_tokens"), known.alias("n_encoded"), (total - known).alias("n_lost"))


@query("decode_vocab", with_ctes("tokens", extra=VOCAB_CTES) + """
select e.pn_num, string_agg(coalesce(v.token, '[UNK]'), ' ' order by e.tok_no) decoded
from enc e left join vk v using (idx) group by e.pn_num""")
def decode_vocab(fx):
    inv = _vocab(fx).select("idx", F.col("token").alias("word"))

    e = encoded_tokens(fx).select("pn_num", "tok_no", "idx").join(inv, "idx", "left") \
        .withColumn("word", F.coalesce("word", F.lit("[UNK]")))
    lst = F.sort_array(F.collect_list(F.struct("tok_no", "word")))
    return e.groupBy("pn_num").agg(F.array_join(F.transform(lst, lambda x: x["word"]), " ").alias("decoded"))


@query("tokenize_distinct_join", with_ctes("tokens") + "select pn_num, tok_no, token, s, e from tokens")
def tokenize_distinct_join(fx):
    """Tokenise each distinct text once (dedup on a text digest), join back."""
    n = fx.notes.select("pn_num", F.sha2("pn_history", 256).alias("h"), "pn_history")
    distinct = n.select("h", "pn_history").dropDuplicates(["h"])
    # one row a text until it is back with its notes, then exploded: a much-copied text is split by AQE as rows, not tokens
    packed = tokens_of(distinct, ["h"], "pn_history").groupBy("h").agg(
        F.collect_list(F.struct("tok_no", "token", "s", "e")).alias("t"))
    return n.select("pn_num", "h").join(packed, "h").select("pn_num", F.inline("t"))


@query("cached_vocab", with_ctes("tokens", extra=VOCAB_CTES[:2]) + "select token, cnt, idx from vk")
def cached_vocab(fx):
    """Compute-or-load: the vocabulary is materialised once per input content
    and K in the shared checkpoint folder and re-read afterwards.  The content
    key is made of the input files' names, sizes and modification times, as
    Spark's file source lists them, so changed data is computed anew."""
    files = fx.t.documents.select("_metadata.file_path", "_metadata.file_size", "_metadata.file_modification_time").distinct()
    one = F.concat_ws("|", *[F.col(c).cast("string") for c in files.columns])
    key = files.agg(F.md5(F.array_join(F.array_sort(F.collect_list(F.md5(one))), ","))).first()[0]
    root = f"{ensure_checkpoint_dir(fx.spark).rstrip('/')}/cache/vocab_{K}_{key}"
    return FS.compute_or_load(fx.spark, root, lambda: _vocab(fx))


SEQ_CTES = VOCAB_CTES + [
    ("fw", f"""select feature_num, unnest(w) token, unnest(range(1, len(w) + 1)) tok_no from (
       select feature_num, regexp_extract_all(lower(replace(replace(replace(feature_text, 'I-year', '1-year'), '-OR-', ' or '),
         '-', ' ')), '{WORD}') w from features)"""),
    ("fenc", f"""select feature_num, list(coalesce(v.idx, {OOV}) + 3 order by tok_no) fids
       from fw left join vk v using (token) group by feature_num"""),
    ("nseq", """select pn_num, list(e.idx + 3 order by e.tok_no) nids, list(t.s order by e.tok_no) ss, list(t.e order by e.tok_no) es
       from enc e join tokens t using (pn_num, tok_no) group by pn_num"""),
    ("len", """select max(len(regexp_extract_all(pn_history, '[\\p{L}\\p{N}]+'))) + (select max(len(fids)) from fenc) + 3 max_len from notes"""),
    ("pair", """select t.id, coalesce(f.fids, []) fids, n.nids, n.ss, n.es, (select max_len from len) max_len
       from train t left join fenc f using (feature_num) join nseq n using (pn_num)"""),
]


def _pairs(fx, of_note, max_tokens=None):
    """(id, fids, max_len, ...): feature ids of each row, the length that holds
    every pair whole (longest note + longest feature + 3 specials, taken from
    the data), and the columns ``of_note`` of its note's ``nids``, ``ss`` and ``es``.

    ``of_note`` is evaluated once a note, not once for each of its rows.  It
    sees all tokens of the note, or with ``max_tokens`` at least the first so many."""
    vocab = checkpoint_table(_vocab(fx))  # read by the features and the notes
    f = fx.features.select("feature_num", F.posexplode(F.regexp_extract_all(
        F.lower(norm_feature_text("feature_text")), F.lit(WORD), 0)).alias("p", "token"))
    f = V.encode(f.withColumn("tok_no", F.col("p") + 1), vocab, OOV).withColumn("tid", F.col("idx") + V.ID_SHIFT)
    fids = V.id_sequences(f, "feature_num").withColumnRenamed("ids", "fids")
    lst = F.sort_array(F.collect_list(F.struct("tok_no", "tid", "s", "e")))
    tokens = fx.tokens if max_tokens is None else fx.tokens.filter(F.col("tok_no") <= max_tokens)
    enc = V.encode(tokens.drop("pos"), vocab, OOV).withColumn("tid", F.col("idx") + V.ID_SHIFT)
    notes = enc.groupBy("pn_num").agg(lst.alias("t")).select(
        "pn_num", F.col("t")["tid"].alias("nids"), F.col("t")["s"].alias("ss"), F.col("t")["e"].alias("es"))
    notes = notes.select("pn_num", *of_note)
    longest = fx.notes.agg(F.max(F.regexp_count("pn_history", F.lit(WORD)))).scalar() \
        + fids.agg(F.max(F.size("fids"))).scalar() + 3
    t = fx.train.select("id", "pn_num", "feature_num").join(fids, "feature_num", "left").join(notes, "pn_num")
    return t.select("id", F.coalesce("fids", F.array().cast("array<int>")).alias("fids"), longest.cast("int").alias("max_len"),
                    *[c for c in notes.columns if c != "pn_num"])


def _offset_texts():
    return F.zip_with("ss", "es", lambda s, e: F.concat_ws(" ", s.cast("string"), e.cast("string")))


@query("encode_pair", with_ctes("tokens", "features", "train", extra=SEQ_CTES) + """
select id, array_to_string(list_concat([1], fids, [2], nids, [2]), ' ') input_ids,
  array_to_string(list_concat(list_transform(range(len(fids) + 2), lambda x: 0), list_transform(range(len(nids) + 1), lambda x: 1)), ' ')
    token_type_ids, (len(fids) + len(nids) + 3)::int n_real, (max_len - len(fids) - len(nids) - 3)::int n_pad,
  array_to_string(list_concat([1], fids, [2, 2], nids, [2]), ' ') input_ids_two_sep,
  array_to_string(list_concat(list_transform(range(len(fids) + 3), lambda x: '0 0'),
    list_transform(list_zip(ss, es), lambda x: x[1] || ' ' || x[2]), ['0 0']), ';') offsets_two_sep,
  (max_len + 1 - len(fids) - len(nids) - 4)::int n_pad_two_sep from pair""")
def encode_pair(fx):
    """Both separator modes: CLS first SEP second SEP with segment types, and CLS
    first SEP SEP second SEP with all-zero types and the parallel offsets.  The
    padding is a run of one value, given by its length (``n_pad``) up to the
    data's ``max_len``; nothing is truncated."""
    p = _pairs(fx, [V.ints_to_text(F.col("nids")).alias("ntext"), F.size("nids").alias("n"),
                    F.array_join(_offset_texts(), ";").alias("offs")])
    n_first, n = F.size("fids"), F.size("fids") + F.col("n") + 3
    zeros = F.concat(F.repeat(F.lit("0 0;"), n_first + 3), F.col("offs"), F.lit(";0 0"))
    p = p.withColumn("ftext", F.when(n_first > 0, V.ints_to_text(F.col("fids"))))
    return p.select("id", V.pair_text("ftext", "ntext", 1).alias("input_ids"),
                    V.pair_types_text(n_first, F.col("n")).alias("token_type_ids"),
                    n.alias("n_real"), (F.col("max_len") - n).alias("n_pad"),
                    V.pair_text("ftext", "ntext", 2).alias("input_ids_two_sep"), zeros.alias("offsets_two_sep"),
                    (F.col("max_len") + 1 - (n + 1)).alias("n_pad_two_sep"))


def _truncated_sql(sep: int, second_type: int) -> str:
    n = MAX_LEN
    head = "list_concat([1], fids, [" + ", ".join(["2"] * sep) + "])"
    return f"""select id, len(list_concat(h, nids)[1:{n - 1}])::int + 1 n_real,
  array_to_string(list_concat(list_concat(h, nids)[1:{n - 1}], [2], list_transform(range({n - 1} - len(list_concat(h, nids)[1:{n - 1}])), lambda x: 0)), ' ') input_ids,
  array_to_string(list_transform(range({n}), lambda i: case when i >= len(h) and i < len(list_concat(h, nids)[1:{n - 1}]) + 1 then {second_type} else 0 end), ' ') token_type_ids,
  array_to_string(list_concat(list_concat(list_transform(range(len(h)), lambda x: '0 0'),
    list_transform(list_zip(ss, es), lambda x: x[1] || ' ' || x[2]))[1:{n - 1}],
    list_transform(range({n} - len(list_concat(h, nids)[1:{n - 1}])), lambda x: '0 0')), ';') offset_mapping
  from (select *, {head} h from pair)"""


@query("encode_pair_truncated", with_ctes("tokens", "features", "train", extra=SEQ_CTES + [
    ("one", _truncated_sql(1, 1)), ("two", _truncated_sql(2, 0))]) + """
select id, one.n_real, one.input_ids, one.token_type_ids, one.offset_mapping, two.n_real n_real_two_sep,
  two.input_ids input_ids_two_sep, two.token_type_ids token_type_ids_two_sep, two.offset_mapping offset_mapping_two_sep
from one join two using (id)""")
def encode_pair_truncated(fx):
    """Fixed-width pairs of ``MAX_LEN``: ids, types and offsets cut together at
    ``MAX_LEN - 1``, a closing separator, padding; with one and with two separators."""
    text = lambda ids: F.transform(ids, lambda x: x.cast("string"))
    cut = lambda c: F.slice(c, 1, MAX_LEN)
    p = _pairs(fx, [cut(text("nids")).alias("nids"), cut(_offset_texts()).alias("offs")], MAX_LEN)
    e = p.select("id", F.size("fids").alias("n_first"), F.size("nids").alias("n_second"), *[
        V.truncated_lists(text("fids"), F.col("nids"), F.col("offs"), k, MAX_LEN, F.lit("0 0"), lambda x: F.lit(str(x))).alias(f"e{k}")
        for k in (1, 2)])

    def cols(k, suffix):
        return [F.least(F.col("n_first") + F.col("n_second") + 2 + k, F.lit(MAX_LEN)).alias(f"n_real{suffix}"),
                *[F.array_join(f"e{k}.{c}", sep).alias(f"{c}{suffix}")
                  for c, sep in (("input_ids", " "), ("token_type_ids", " "), ("offset_mapping", ";"))]]

    return e.select("id", *cols(1, ""), *cols(2, "_two_sep"))


@query("ignore_mask", with_ctes("tokens", "features", "train", extra=SEQ_CTES) + """
select id, array_to_string(list_concat(list_transform(range(len(fids) + 2), lambda x: -1), list_transform(range(len(nids)), lambda x: 0), [-1]), ' ') mask,
  array_to_string(list_concat(list_transform(range(len(fids) + 2), lambda x: -100), list_transform(range(len(nids)), lambda x: 0), [-100]), ' ') mask100,
  len(nids)::int n_kept, (max_len - len(fids) - len(nids) - 3)::int n_pad from pair""")
def ignore_mask(fx):
    """Masks over the real positions; the ``n_pad`` padded ones hold the ignore value too."""
    from ...operators.labels import ignore_mask as mask_expr

    p = _pairs(fx, [F.size("nids").alias("n")])
    total = F.size("fids") + F.col("n") + 3
    return p.select("id", V.ints_to_text(mask_expr(F.size("fids"), total, -1)).alias("mask"),
                    V.ints_to_text(mask_expr(F.size("fids"), total, -100)).alias("mask100"),
                    F.col("n").alias("n_kept"), (F.col("max_len") - total).alias("n_pad"))


@query("encode_single_mask", with_ctes("tokens", extra=VOCAB_CTES + [
    ("seq", "select pn_num, list(idx + 3 order by tok_no) ids from enc where tok_no <= 510 group by pn_num")]) + """
select pn_num, array_to_string(list_concat([1], ids, [2], list_transform(range(510 - len(ids)), lambda x: 0)), ' ') input_ids,
  array_to_string(list_concat(list_transform(range(len(ids) + 2), lambda x: 1), list_transform(range(510 - len(ids)), lambda x: 0)), ' ') attention_mask,
  (len(ids) + 2)::int n_attention from seq""")
def encode_single_mask(fx):
    s = V.id_sequences(encoded_tokens(fx), "pn_num", max_tokens=510)
    enc = V.single_encoding(F.col("ids"), 512)
    mask = V.attention_mask(enc)
    return s.select("pn_num", V.ints_to_text(enc).alias("input_ids"), V.ints_to_text(mask).alias("attention_mask"),
                    F.aggregate(mask, F.lit(0), lambda a, x: a + x).alias("n_attention"))


@query("pad_id_sequences", with_ctes("tokens", extra=VOCAB_CTES + [
    ("txt", "select pn_num, array_to_string(list(idx + 3 order by tok_no), ' ') ids from enc group by pn_num")]) + """
select pn_num, array_to_string(list_concat(l, list_transform(range(250 - len(l)), lambda x: 0)), ' ') padded,
  len(l)::int n_nonzero from (
  select pn_num, list_transform(string_split(ids, ' ')[1:250], lambda x: x::int) l from txt)""")
def pad_id_sequences(fx):
    s = V.id_sequences(encoded_tokens(fx), "pn_num", max_tokens=250).select("pn_num", V.ints_to_text(F.col("ids")).alias("txt"))
    ids = F.transform(F.slice(F.split("txt", " "), 1, 250), lambda x: x.cast("int"))
    return s.select("pn_num", V.ints_to_text(V.zero_pad(ids, 250)).alias("padded"),
                    F.size(ids).cast("int").alias("n_nonzero"))
