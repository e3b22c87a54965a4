"""The queries of this subpackage, one for each operator, and their SQL where SQL can express them."""

from __future__ import annotations

import string

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import chat, decontaminate, fingerprint, jaccard, langid, lines, merkle, negatives, packing, quality, substring, token_counts, token_files


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_file(name: str) -> str:
    """Where a public tokenizer's file is on this machine."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pre-tokens and tokens of every document."""
    return token_counts.token_counts(_table(spark, sf_dir, "documents"), tokenizer_file("piece_bpe_32k.model"))


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts and verdicts of every document."""
    return quality.quality(_table(spark, sf_dir, "documents"))


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Languages of every document, by models learned from those that aren't held out; rejected: no model claims the text."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 4 == 2, F.lit(False))
    model = langid.train(docs.where(~held_out))
    out = langid.predict(docs.select("doc_id", "text"), model)
    return out.select("doc_id", held_out.alias("held_out"), "language.lang_pred", "language.score", "language.rejected")


def op4_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with the benchmark items that they hold."""
    return decontaminate.contained_items(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op5_preference_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A row for each pair of a conversation and the same with another's last answer."""
    turns = chat.answer_swaps(_table(spark, sf_dir, "conversations"))
    return chat.preference_rows(turns, chat.adjacent_pairs(turns))


def op6_packed_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token ids of every document, written to files and read back."""
    docs = _table(spark, sf_dir, "documents")
    return token_files.read_token_files(token_files.write_token_files(docs, token_files.new_folder(spark), tokenizer_file("word_bpe_49k.json")))


def op7_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of every document without windows of 13 words that an earlier one has."""
    return substring.remove_repeats(_table(spark, sf_dir, "documents"), with_text=False)


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the boilerplate lines of its source."""
    return lines.drop_boilerplate(_table(spark, sf_dir, "documents")).select("doc_id", "text", "n_lines", "n_dropped")


def op9_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with the component of near copies it is in."""
    return jaccard.near_duplicates(_table(spark, sf_dir, "documents"))


def op10_length_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's place in batches of like lengths. Lengths, in the column n_tokens, are words here, and token counts in the pipeline."""
    return packing.pack(_table(spark, sf_dir, "documents"))


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Negatives of every hundredth vector; every seventh has the label after its own."""
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.hard_negatives(_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, label=label)


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Proof of every document's leaf, and of a leaf with its text in lower case for a fifth of the ids."""
    low = F.translate("text", string.ascii_uppercase, string.ascii_lowercase)
    return merkle.manifest(_table(spark, sf_dir, "documents"), altered={"text": low}, where=F.crc32(F.col("doc_id").cast("string")) % 5 == 0)


def op13_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of every document and of its edited text, and their likeness."""
    return fingerprint.edit_likeness(_table(spark, sf_dir, "documents"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_token_counts, op2_quality_rules, op3_language_id, op4_decontaminate, op5_preference_format,
        op6_packed_ids, op7_substring_dedup, op8_line_dedup, op9_jaccard_join, op10_length_buckets,
        op11_hard_negatives, op12_merkle_manifest, op13_fingerprints,
    )
}

_W = r"[^\x20\x09-\x0D]+"

_LOW = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"



def _merkle_sql(source_levels: int = 6, root_levels: int = 3) -> str:
    """The tree level by level: place and hash of what each document is in, for 16 ** source_levels documents of a source and 16 ** root_levels sources."""
    enc = lambda x: f"coalesce(cast(strlen(cast({x} as varchar)) as varchar) || ':' || cast({x} as varchar), '-')"
    h = lambda text: "sha256(" + " || ".join(enc(c) for c in ("doc_id", "source", "lang", "n_chars", text)) + ")"
    parts = [rf"""crc as (select list(v order by i) as t from (select i, list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, z: case when c % 2 = 1 then xor(c >> 1, 3988292384) else c >> 1 end) as v from range(256) r(i))),
d as (select *, cast(doc_id as varchar) as k, {h('text')} as leaf, {h(_LOW)} as lower_leaf from documents),
e as (select d.*, xor(4294967295, list_reduce(list_prepend(cast(4294967295 as bigint), [cast(ascii(x) as bigint) for x in string_split(k, '')]), lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1]))) as sum_ from d, crc),
a0 as (select *, case when sum_ % 5 = 0 then lower_leaf else leaf end as folded, row_number() over (partition by source order by doc_id nulls first, leaf) as n, row_number() over (partition by source order by doc_id nulls first, leaf) - 1 as p,
  count(*) over (partition by source) as m, leaf as h, '' as proof from e)"""]

    def climb(k: int, of: str, group: str) -> None:
        """Level k + 1 from level k: nodes are the distinct (group, p, h); one is left as it is."""
        same = "x.source is not distinct from y.source" if group else "true"
        parts.append(f"""b{k} as (select {group + ',' if group else ''} p // 16 as q, list(h order by p) as hs from (select distinct {group + ',' if group else ''} p, h from {of}) group by all),
a{k + 1} as (select x.* replace (case when m > 1 then q else p end as p, case when m > 1 then (m + 15) // 16 else m end as m, case when m > 1 then sha256(array_to_string(hs, '')) else h end as h,
  case when m > 1 then proof || array_to_string(hs[1:p % 16], '') || array_to_string(hs[p % 16 + 2:], '') else proof end as proof,
  case when m > 1 then sha256(array_to_string(hs[1:p % 16], '') || folded || array_to_string(hs[p % 16 + 2:], '')) else folded end as folded) from {of} x join b{k} y on {same} and x.p // 16 = y.q)""")

    for k in range(source_levels):
        climb(k, f"a{k}", "source")
    k = source_levels
    parts.append(f"s as (select source, row_number() over (order by source nulls first) - 1 as g, count(*) over () as gs from (select distinct source from a0)), c{k} as (select x.* replace (g as p, gs as m), h as subroot from a{k} x join s on x.source is not distinct from s.source)")
    climb(k, f"c{k}", "")
    for j in range(k + 1, k + root_levels):
        climb(j, f"a{j}", "")
    return f"with {', '.join(parts)} select doc_id, leaf, subroot, h as root, sha256(proof) as proof_sha256, folded as folded_root, folded = h as verified from a{k + root_levels}"


_STOP = ", ".join(f"'{w}'" for w in quality.STOP_WORDS)

ORACLE_SQL = {
    "op2_quality_rules": rf"""
with t as (select doc_id, coalesce(text, '') as text, regexp_extract_all(coalesce(text, ''), '{_W}') as w from documents),
l as (select *, list_filter(string_split(text, chr(10)), lambda s: regexp_matches(s, '{_W}')) as ls,
  [hash(w[i:i+4]) for i in range(1, len(w) - 3)] as g from t),
d as (select doc_id, h, p, count(*) over (partition by doc_id, h) as n from (select doc_id, unnest(g) as h, unnest(range(1, len(g) + 1)) as p from l)),
c as (select doc_id, count(distinct p + k) as n_repeat_words from d, range(5) as r(k) where n >= 2 group by doc_id),
m as (select l.doc_id, cast(len(w) as bigint) as n_words, cast(coalesce(list_sum([length(x) for x in w]), 0) as bigint) as word_chars,
  cast(length(text) - length(translate(text, '#*$%&|<>', '')) as bigint) as n_symbols,
  cast(len(ls) - len(list_distinct(ls)) as bigint) as n_dup_lines, coalesce(n_repeat_words, 0) as n_repeat_words,
  len(list_filter(w, lambda x: lower(x) in ({_STOP}))) as n_stop, len(ls) as n_lines from l left join c using (doc_id))
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
  n_words < 10 or 100 * n_repeat_words > 20 * n_words as base_failed,
  not (n_words < 10 or 100 * n_repeat_words > 20 * n_words) and word_chars / n_words between 1.5 and 20.0
  and n_symbols / n_words <= 0.25 and n_stop / n_words between 0.01 and 0.8 and (n_lines = 0 or n_dup_lines / n_lines <= 0.5) as kept
from m""",
    "op4_decontaminate": rf"""
with iw as (select item_id, regexp_extract_all({_LOW}, '{_W}') as w from benchmark), dw as (select doc_id, regexp_extract_all({_LOW}, '{_W}') as w from documents),
i as (select distinct item_id, least(len(w), 5) as k, unnest([array_to_string(w[p:p + least(len(w), 5) - 1], ' ') for p in range(1, len(w) - least(len(w), 5) + 2)]) as g from iw where len(w) > 0),
d as (select distinct doc_id, k, unnest([array_to_string(w[p:p + k - 1], ' ') for p in range(1, len(w) - k + 2)]) as g from dw, (select distinct k from i) where len(w) >= k),
n as (select item_id, count(*) as n_item from i group by item_id), p as (select doc_id, item_id, count(*) as n_shared from d join i using (k, g) group by all)
select doc_id, item_id, n_shared, n_item from p join n using (item_id) where 100 * n_shared >= 80 * n_item""",
    "op5_preference_format": r"""
with t as (select conv_id as c, turn, role, text from conversations where conv_id is not null and turn is not null),
l as (select c, max(turn) as last from t where role = 'assistant' group by c),
e as (select t.*, last from t join l using (c) where turn <= last),
u as (select c as pair_id, 'chosen' as side, turn, coalesce(role, '') as role, coalesce(text, '') as text from e
  union all select c, 'rejected', turn, coalesce(role, ''), coalesce(text, '') from e where turn < last
  union all select l.c, 'rejected', l.last, coalesce(role, ''), coalesce(text, '') from e join l on xor(e.c, 1) = l.c where e.turn = e.last and role = 'assistant'),
s as (select pair_id, turn, side, list_sort(list(role || chr(0) || text)) as sign from u group by all),
d as (select coalesce(a.pair_id, b.pair_id) as pair_id, coalesce(a.turn, b.turn) as turn, a.sign is distinct from b.sign as differs
  from (select * from s where side = 'chosen') a full join (select * from s where side = 'rejected') b on a.pair_id = b.pair_id and a.turn = b.turn),
f as (select pair_id, min(turn) filter (where differs) as first from d group by pair_id),
x as (select u.*, coalesce(turn < first, true) as shared from u join f using (pair_id)),
g as (select pair_id, case when shared then 'prompt' else side end as part, turn, role, text, not shared and role = 'assistant' as trained,
  '<|im_start|>' || role || chr(10) || text || '<|im_end|>' || chr(10) as segment, length(role) + 13 as head from x where not shared or side = 'chosen'),
o as (select *, coalesce(sum(length(segment)) over (partition by pair_id, part order by turn, role, text rows between unbounded preceding and 1 preceding), 0) as ahead,
  row_number() over (partition by pair_id, part order by turn, role, text) as place from g),
m as (select pair_id, part, string_agg(segment, '' order by place) as whole,
  coalesce(string_agg(cast(ahead + head as bigint) || '-' || cast(ahead + length(segment) - 1 as bigint), ' ' order by place) filter (where trained), '') as mask from o group by all)
select pair_id, coalesce(max(whole) filter (where part = 'prompt'), '') as prompt, coalesce(max(whole) filter (where part = 'chosen'), '') as chosen,
  coalesce(max(whole) filter (where part = 'rejected'), '') as rejected, coalesce(max(mask) filter (where part = 'chosen'), '') as chosen_mask,
  coalesce(max(mask) filter (where part = 'rejected'), '') as rejected_mask from m group by pair_id""",
    "op7_substring_dedup": rf"""
with w as (select doc_id, regexp_extract_all(coalesce(text, ''), '{_W}') as w from documents),
p as (select doc_id, unnest(range(1, len(w) - 11)) as p, w from w where len(w) >= 13),
g as (select doc_id, p, array_to_string(w[p:p+12], ' ') as g from p),
m as (select doc_id, p, min(doc_id) over (partition by g) as least from g),
r as (select distinct doc_id, p + k as p from m, range(13) as r(k) where least < doc_id),
l as (select doc_id, list(p) as gone from r group by doc_id)
select w.doc_id, cast(len(w) as bigint) as n_words, cast(coalesce(len(gone), 0) as bigint) as n_removed,
  sha256(array_to_string([w[i] for i in range(1, len(w) + 1) if not coalesce(list_contains(gone, i), false)], ' ')) as kept_sha256
from w left join l using (doc_id)""",
    "op8_line_dedup": f"""
with p as (select doc_id, source, text, string_split(text, chr(10)) as ls from documents),
u as (select source, doc_id, unnest(list_distinct([trim(s) for s in ls if trim(s) <> ''])) as s from p where source is not null),
c as (select source, s, count(*) as n from u group by all),
h as (select source, count(*) as pages from documents where source is not null group by source),
b as (select source, list(s) as drops from c join h using (source) where n >= {lines.MIN_PAGES} and n > {lines.RATIO} * pages group by source),
k as (select doc_id, text, coalesce(len(ls), 0) as n_lines, case when drops is not null then [s for s in ls if trim(s) = '' or not list_contains(drops, trim(s))] else ls end as stay from p left join b using (source))
select doc_id, case when text is not null then coalesce(array_to_string(stay, chr(10)), '') end as text, cast(n_lines as bigint) as n_lines,
  cast(n_lines - coalesce(len(stay), 0) as bigint) as n_dropped from k""",
    "op9_jaccard_join": rf"""
with recursive w as (select doc_id, regexp_extract_all({_LOW}, '{_W}') as w from documents),
g as (select distinct doc_id, unnest(case when len(w) >= 5 then [array_to_string(w[i:i+4], ' ') for i in range(1, len(w) - 3)]
  when len(w) > 0 then ['<' || array_to_string(w, ' ') || '>'] else [] end) as g from w),
n as (select doc_id, count(*) as n from g group by doc_id),
k as (select doc_id, n, md5(string_agg(g, chr(1) order by g)) as k from g join n using (doc_id) group by all),
reps as (select k, min(doc_id) as rep, any_value(n) as n from k group by k),
h as (select doc_id, g, n from g join reps on doc_id = rep),
e as materialized (select a.doc_id as a, b.doc_id as b from h a join h b on a.g = b.g and a.doc_id <> b.doc_id and 5 * a.n >= 4 * b.n and 5 * b.n >= 4 * a.n
  group by a.doc_id, b.doc_id, a.n, b.n having 100 * count(*) >= 80 * (a.n + b.n - count(*))),
c as (select rep as a, rep as c from reps union select e.b, c.c from c join e on e.a = c.a),
l as (select a as rep, min(c) as component from c group by a)
select documents.doc_id, cast(coalesce(k.n, 0) as bigint) as n_shingles, coalesce(l.component, documents.doc_id) as component_id
from documents left join k using (doc_id) left join reps on reps.k = k.k left join l on l.rep = reps.rep""",
    "op11_hard_negatives": """
with v as (select vec_id, cast(case when vec_id % 7 = 0 then (label + 1) % 10 else label end as bigint) as label, [floor(256 * cast(x as double)) for x in embedding] as e from embeddings
  where label is not null and embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
s as (select a.vec_id as a, b.vec_id as b, a.label = b.label as same, cast(list_dot_product(a.e, b.e) as bigint) as s from v a join v b on a.vec_id % 100 = 0 and a.vec_id <> b.vec_id),
p as (select * from (select *, row_number() over (partition by a order by s desc, b) as r from s where same) where r <= 5),
n as (select p.a, p.b, p.s, q.b as n, q.s as ns, row_number() over (partition by p.a, p.b order by q.s desc, q.b) as r from p join s q on q.a = p.a and not q.same and 100 * q.s between 30 * p.s and 90 * p.s)
select a as anchor_id, b as positive_id, cast(r as integer) as rank, n as negative_id, s as positive_score, ns as negative_score from n where r <= 10""",
    "op12_merkle_manifest": _merkle_sql(),
}
