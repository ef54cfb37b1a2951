"""One query per operator, each over its whole table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from municare.llm import (
    bpe, chat, decontaminate, embed, ftrl, hosts, licenses, lines, merkle, minhash, mixing, repair, trees,
)
from municare.llm.common import table
from municare.llm.registry import query

VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")
WORD = r"[^\x20\x09-\x0D]+"

# A run of 50 words or more that begins at each line and no line sooner, and one that ends
# there; all places of equal runs, the earliest first; what later ones cover goes.
_RUNS = f"""
with cut as (
  select doc_id, text, unnest(string_split(text, chr(10))) line,
         unnest(range(len(string_split(text, chr(10))))) n
  from documents where text is not null),
worded as (
  select *, len(regexp_extract_all(line, '{WORD}')) words from cut where regexp_matches(line, '{WORD}')),
placed as (
  select *, row_number() over (partition by doc_id order by n) i,
         sum(words) over (partition by doc_id order by n) done from worded),
spans as (
  select a.doc_id, a.i low, min(b.i) high from placed a join placed b
    on a.doc_id = b.doc_id and b.i >= a.i and b.done - a.done + a.words >= 50 group by all
  union
  select b.doc_id, max(a.i) low, b.i high from placed a join placed b
    on a.doc_id = b.doc_id and b.i >= a.i and b.done - a.done + a.words >= 50 group by all),
runs as (
  select s.doc_id, low, high, list(line order by i) run
  from spans s join placed p on s.doc_id = p.doc_id and p.i between low and high group by all),
firsts as (
  select run, min((doc_id, low, high)) first from runs group by run having count(*) > 1),
gone as (
  select distinct r.doc_id, i from (
    select doc_id, case when doc_id = first[1] then greatest(low, first[3] + 1) else low end a, high b
    from runs join firsts using (run) where (doc_id, low, high) <> first) r,
  unnest(generate_series(a, b)) as t(i)),
left_over as (
  select c.doc_id, c.n, c.line, p.i is not null worded, g.i is not null gone
  from cut c left join placed p using (doc_id, n) left join gone g on g.doc_id = p.doc_id and g.i = p.i),
done as (
  select doc_id, count(*) filter (worded) n_lines, count(*) filter (gone) n_deleted,
         case when count(*) filter (worded) = 0 then string_agg(line, chr(10) order by n)
              when count(*) filter (worded and not gone) = 0 then ''
              else string_agg(line, chr(10) order by n) filter (not gone) end as text
  from left_over group by doc_id)
select d.doc_id, coalesce(n_lines, 0) n_lines, coalesce(n_deleted, 0) n_deleted,
       case when d.text is null then null else done.text end as text
from documents d left join done using (doc_id)"""


# Every prefix of every conversation as a list; those that end no longer one stay.
_CHATS = f"""
with turns as (select distinct conv_id, turn, role, text from conversations),
placed as (
  select *, row_number() over (partition by conv_id order by turn nulls first, role nulls first, text nulls first) place
  from turns),
prefixes as (
  select conv_id, place, count(*) over (partition by conv_id) n_turns,
         list(struct_pack(role, text)) over (partition by conv_id order by place) prefix from placed),
whole as (select prefix, n_turns, min(conv_id) conv_id from prefixes where place = n_turns group by all),
kept as (
  select * from whole where prefix not in (select prefix from prefixes where place < n_turns))
select k.conv_id, cast((place - 1) // {chat.PART_TURNS} as int) part, n_turns,
       string_agg('{chat.OPEN}' || coalesce(role, '') || chr(10) || coalesce(text, '') || '{chat.CLOSE}' || chr(10), ''
                  order by place) as rendered
from kept k join placed p on k.conv_id is not distinct from p.conv_id
group by all"""


@query("op1_chat_format", _CHATS)
def op1(spark: SparkSession, folder: str) -> DataFrame:
    return chat.format_chats(table(spark, folder, "conversations"))


@query("op2_embedding_near_dedup")
def op2(spark: SparkSession, folder: str) -> DataFrame:
    return embed.near_duplicates(table(spark, folder, "embeddings"))


@query("op3_line_dedup", _RUNS)
def op3(spark: SparkSession, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents").select("doc_id", "text")
    return lines.line_dedup(documents)


_PRIOR = """
  select {group}, n, bad, prior,
         case when spread > 0 then greatest({low}, least({high}, 1 / spread - 1)) else {high} end strength
  from (select *, (sum(case when n > 0 then n * (bad / n - prior) ** 2 end) over ()
                   - sum(case when n > 0 then prior * (1 - prior) end) over ())
                / nullif(sum(case when n > 0 then prior * (1 - prior) end) over ()
                         * (sum(n) over () - count(case when n > 0 then 1 end) over ())
                         / nullif(count(case when n > 0 then 1 end) over (), 0), 0) spread
        from ({rows}))"""
_MEAN = "(bad + prior * strength) / (n + strength)"
_level = lambda group, rows: _PRIOR.format(
    group=group, rows=rows, low=hosts.LEAST_STRENGTH, high=hosts.MOST_STRENGTH
)
_longest = " ".join(
    f"when (host = '{h}' or ends_with(host, '.{h}')) and starts_with(path, '{p}') then '{{{i}}}'"
    for i, (_, h, p) in sorted(enumerate(hosts.RULES), key=lambda r: -len(r[1][1] + r[1][2]))
)
_HOSTS = f"""
with cut as (
  select page_id, coalesce(translate(regexp_extract(url, '^.*?://([^/?#]*)', 1, 's'), '{hosts.UPPER}', '{hosts.LOWER}'), '') host,
         coalesce(regexp_extract(url, '^.*?://[^/?#]*([^?#]*)', 1, 's'), '') path from pages),
outcomes as (select doc_id, max(1 - quality) bad from labels where quality is not null group by doc_id),
by_host as (
  select host, regexp_extract(regexp_replace(regexp_replace(host, '^.*@', ''), ':[0-9]*$', ''), '([^.]*[.])?[^.]*$', 0) domain,
         count(bad) n, coalesce(sum(bad), 0) bad from cut left join outcomes on doc_id = page_id group by all),
by_domain as (
  select domain, regexp_extract(domain, '[^.]*$', 0) suffix, sum(n) n, sum(bad) bad from by_host group by all),
suffixes as (
  {_level("suffix", "select suffix, sum(n) n, sum(bad) bad, sum(sum(bad)) over () / nullif(sum(sum(n)) over (), 0) prior from by_domain group by suffix")}),
domains as (
  {_level("domain", f"select d.domain, d.n, d.bad, s.prior from by_domain d join (select suffix, {_MEAN} prior from suffixes) s using (suffix)")}),
known as (
  {_level("host", f"select h.host, h.n, h.bad, d.prior from by_host h join (select domain, {_MEAN} prior from domains) d using (domain)")}),
bounds as (
  select host, mean bad_rate, mean - {hosts.BOUND} * sqrt(mean * (1 - mean) / (n + strength + 1)) bad_low
  from (select *, {_MEAN} mean from known))
select page_id, host, path, case {_longest.format(*[h + p for _, h, p in hosts.RULES])} end as rule,
       case {_longest.format(*[v for v, _, _ in hosts.RULES])}
            when bad_low > {hosts.ALLOWED_RATE} then 'block' else 'allow' end as verdict,
       bad_rate, bad_low
from cut join bounds using (host)"""


@query("op4_url_filter", _HOSTS)
def op4(spark: SparkSession, folder: str) -> DataFrame:
    # The labels carry ids of the same range as the pages; a label of poor quality is the
    # outcome of the page with its id.
    labels = table(spark, folder, "labels")
    outcomes = labels.select(F.col("doc_id").alias("page_id"), (F.lit(1) - F.col("quality")).alias("bad"))
    return hosts.judge_urls(table(spark, folder, "pages"), outcomes)


@query("op5_quality_rules")
def op5(spark: SparkSession, folder: str) -> DataFrame:
    rows = trees.quality_rules(table(spark, folder, "documents"), table(spark, folder, "labels"))
    return rows.select("doc_id", *trees.COUNTS, "base_failed", "kept")


@query("op6_quality_classifier")
def op6(spark: SparkSession, folder: str) -> DataFrame:
    return ftrl.classify(table(spark, folder, "documents"), table(spark, folder, "labels"))


@query("op7_bpe")
def op7(spark: SparkSession, folder: str) -> DataFrame:
    return bpe.digests(table(spark, folder, "documents"), VOCABULARY, ["doc_id"])


@query("op8_mixing")
def op8(spark: SparkSession, folder: str) -> DataFrame:
    rows = mixing.mix(table(spark, folder, "documents"))
    taken = (rows["times"] * rows["size"]).alias("taken")
    return rows.select("doc_id", "size", "source_size", "target", taken)


@query("op9_license_scan")
def op9(spark: SparkSession, folder: str) -> DataFrame:
    # The tables hold no paths: a source is the folder of its documents, so that a whole licence text in it holds
    # for those without a licence of their own. Without a source a document has no path and inherits nothing.
    path = F.when(F.col("source") != "", F.concat_ws("/", "source", F.coalesce(F.col("doc_id").cast("string"), F.lit("-"))))
    return licenses.scan_licenses(table(spark, folder, "documents").withColumn("path", path))


@query("op10_minhash")
def op10(spark: SparkSession, folder: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, folder, "documents"))


# CRC-32 of a text of ASCII characters, bit by bit.
def _crc(text: str) -> str:
    codes = f"list_transform(string_split({text}, ''), lambda c: ascii(c)::bigint)"
    bits = "list_reduce([xor(a, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, y: xor(x >> 1, (x & 1) * 3988292384))"
    return f"xor(list_reduce(list_concat([4294967295::bigint], {codes}), lambda a, b: {bits}), 4294967295)"


_told = lambda v: f"coalesce(strlen({v}) || ':' || {v}, '-')"
_leaf = lambda text: "sha256(" + " || ".join(
    _told(v) for v in ("doc_id::varchar", "source", "lang", "n_chars::varchar", text)
) + ")"
_MERKLE = f"""
with recursive leaves as (
  select doc_id, lang, {_leaf("text")} leaf,
         {_leaf(f"case when {_crc('doc_id::varchar')} % 3 = 0 then translate(text, '{merkle.UPPER}', '{merkle.LOWER}') else text end")} claim
  from documents),
placed as (
  select *, row_number() over (partition by lang order by doc_id nulls first, leaf, claim) - 1 slot,
         dense_rank() over (order by lang nulls first) - 1 g, count(*) over (partition by lang) n from leaves),
trees as (
  select g, 0 level, slot, n, leaf digest, null::varchar[] kids from placed
  union all
  select g, level + 1, slot // 8, (n + 7) // 8, sha256(string_agg(digest, '' order by slot)), list(digest order by slot)
  from trees where n > 1 group by g, level, slot // 8, n),
subroots as (select g, level top, digest subroot, count(*) over () groups from trees where n = 1),
tops as (
  select -1 g, 0 level, g slot, groups n, subroot digest, null::varchar[] kids from subroots
  union all
  select g, level + 1, slot // 8, (n + 7) // 8, sha256(string_agg(digest, '' order by slot)), list(digest order by slot)
  from tops where n > 1 group by g, level, slot // 8, n),
nodes as (select g, level, slot, kids from trees where level > 0 union all select g, level, slot, kids from tops where level > 0),
climb as (
  select g home, slot leaf_slot, g, 0 level, slot, claim folded, '' siblings from placed
  union all
  select home, leaf_slot, g, level, slot, sha256(list_aggregate(list_concat(kids[:place], [folded], kids[place + 2:]), 'string_agg', '')),
         siblings || coalesce(list_aggregate(list_concat(kids[:place], kids[place + 2:]), 'string_agg', ''), '')
  from (
    select c.home, c.leaf_slot, n.g, n.level, n.slot, c.folded, c.siblings, kids,
           case when s.top = c.level and c.g >= 0 then c.g % 8 else c.slot % 8 end place
    from climb c left join subroots s on s.g = c.g
    join nodes n on case when s.top = c.level and c.g >= 0 then n.g = -1 and n.level = 1 and n.slot = c.g // 8
                         else n.g = c.g and n.level = c.level + 1 and n.slot = c.slot // 8 end)),
ends as (select home, leaf_slot, arg_max(folded, (-g, level)) folded, arg_max(siblings, (-g, level)) siblings from climb group by all)
select doc_id, leaf, subroot, root, sha256(siblings) proof_sha256, folded folded_root, folded = root as verified
from placed p join subroots s using (g) join ends e on e.home = p.g and e.leaf_slot = p.slot,
     (select digest root from tops where n = 1)"""


@query("op11_merkle_manifest", _MERKLE)
def op11(spark: SparkSession, folder: str) -> DataFrame:
    changed = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0
    claim = F.when(changed, merkle.lowered("text")).otherwise(F.col("text"))
    columns = ["doc_id", "source", "lang", "n_chars", "text"]
    manifest = merkle.build(table(spark, folder, "documents"), columns, "lang", "doc_id", {"text": claim})
    text = lambda c: F.lower(F.hex(c))
    return merkle.prove(manifest).select(
        "doc_id", text("leaf").alias("leaf"), text("subroot").alias("subroot"), text("root").alias("root"),
        text("proof").alias("proof_sha256"), text("folded_root").alias("folded_root"), "verified",
    )


_lower = f"translate(text, '{merkle.UPPER}', '{merkle.LOWER}')"
_words = rf"regexp_extract_all({_lower}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
_LEAKS = f"""
with docs as (select row_number() over () r, doc_id, coalesce({_words}, []) words from documents),
items as (select coalesce(item_id::varchar, '') item, {_words} words from benchmark where text is not null),
grams as (
  select distinct item, words[i:i + 9] gram
  from (select *, unnest(range(1, greatest(len(words) - 9, 1) + 1)) i from items where len(words) > 0)),
places as (
  select r, i, s, words[i:i + s - 1] gram
  from (select *, unnest(range(1, len(words) - s + 2)) i from docs, (select distinct len(gram) s from grams))),
met as (select r, i, s, item from places join grams using (gram)),
covered as (select r, count(*) n_hit from (select distinct r, unnest(range(i, i + s)) from met) group by r),
found as (select r, count(distinct item) n_items, string_agg(distinct item, ',' order by item) items from met group by r)
select doc_id, len(words)::bigint n_words, coalesce(n_hit, 0) n_hit, coalesce(n_items, 0) n_items,
       sha256(coalesce(items, '')) items_sha256, n_hit is not null as contaminated
from docs left join covered using (r) left join found using (r)"""


@query("op12_decontaminate", _LEAKS)
def op12(spark: SparkSession, folder: str) -> DataFrame:
    told = decontaminate.judge(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
    listed = F.sha2(F.array_join("items", ","), 256).alias("items_sha256")
    return told.select("doc_id", "n_words", "n_hit", "n_items", listed, "contaminated")


# States: 0 nothing, 1 system, 2 user, 3 assistant. All ways over all rows, whole edit strings compared.
_REPAIR = rf"""
with recursive
inserted(state, mid, n, turns) as (values
  (0, 0, 0, []::varchar[]), (0, 2, 1, ['user:']), (0, 3, 2, ['user:', 'assistant:']), (1, 1, 0, []), (1, 2, 1, ['user:']),
  (1, 3, 2, ['user:', 'assistant:']), (2, 2, 0, []), (2, 3, 1, ['assistant:']), (3, 3, 0, []), (3, 2, 1, ['user:'])),
said(mid, initial, state) as (values (0, 's', 1), (0, 'u', 2), (1, 'u', 2), (2, 'a', 3), (3, 'u', 2)),
spoken(mid, role, state) as (values (0, 'user:', 2), (1, 'user:', 2), (2, 'assistant:', 3), (3, 'user:', 2)),
source as (
  select conv_id, turn, coalesce(role, ' ') as role, coalesce(text, ' ') as text,
         {_crc("coalesce(conv_id::varchar, ' ') || ':' || coalesce(turn::varchar, ' ')")} % 20 fault from conversations),
damaged as (
  select conv_id, turn, case when fault = 4 then 'user' else role end as role,
         case fault when 1 then '' when 2 then translate(text, '.!?', '') else text end as text,
         unnest(range(case when fault = 3 then 2 else 1 end)) copy from source where fault <> 0),
numbered as (
  select *, row_number() over (partition by conv_id order by turn nulls first, role, text, copy) i,
         not regexp_matches(text, '[^\x20\x09-\x0D]') blank,
         row_number() over (partition by conv_id, role, text order by turn nulls first, copy) > 1 again,
         regexp_extract(text, '([^\x20\x09-\x0D])[\x20\x09-\x0D]*\z', 1) not in ('.', '!', '?') cut,
         lag(left(role, 1)) over (partition by conv_id order by turn nulls first, role, text, copy) || left(role, 1) pair
  from damaged),
judged as (
  select *, blank or again doomed, case when cut then 5 else 0 end dear, row_number() over () key from numbered),
edits as (
  select key, mid, mid as state, 2 cost, 'D' edit, []::varchar[] turns from judged, (select distinct mid from inserted)
  union all
  select key, mid, state, dear, 'K', [role || ':' || text] from judged join said on initial = left(role, 1) where not doomed
  union all
  select key, mid, mid, dear, 'K', [role || ':' || text] from judged, (select distinct mid from inserted) where role = '' and not doomed
  union all
  select key, mid, state, dear + 1, 'R', [spoken.role || text] from judged, spoken where not doomed),
walk as (
  select distinct conv_id, 0::bigint i, 0 state, struct_pack(cost := 0, audit := '', turns := []::varchar[]) best from source
  union all
  select w.conv_id, w.i + 1, e.state, min(struct_pack(
      cost := w.best.cost + 5 * n + e.cost, audit := w.best.audit || repeat('I', n) || e.edit,
      turns := list_concat(w.best.turns, x.turns, e.turns)))
  from walk w join judged j on j.conv_id is not distinct from w.conv_id and j.i = w.i + 1
  join inserted x on x.state = w.state join edits e on e.key = j.key and e.mid = x.mid group by all),
last_rows as (select conv_id, max(i) i from walk group by conv_id),
ends(state, cost, audit, turns) as (values
  (0, 0, '', []::varchar[]), (3, 0, '', []), (2, 5, 'I', ['assistant:']), (1, 10, 'II', ['user:', 'assistant:'])),
chosen as (
  select w.conv_id, min(struct_pack(cost := w.best.cost + e.cost, audit := w.best.audit || e.audit,
                                    turns := list_concat(w.best.turns, e.turns))) best
  from walk w join last_rows l on l.conv_id is not distinct from w.conv_id and l.i = w.i join ends e using (state) group by w.conv_id),
counted as (
  select conv_id, coalesce(max(turn) - min(turn) + 1 - count(distinct turn), 0) gaps, count(*) filter (blank) as blank,
         count(*) filter (again and not blank) as duplicate, count(*) filter (cut and not again and not blank) as truncated,
         count(*) filter (pair not in ('su', 'ua', 'au')) as illegal from judged group by conv_id)
select c.conv_id, coalesce(gaps, 0) gaps, coalesce(blank, 0) as blank, coalesce(duplicate, 0) as duplicate,
       coalesce(truncated, 0) as truncated, coalesce(illegal, 0) as illegal, best.cost::bigint as cost, best.audit as audit,
       sha256(coalesce(list_aggregate(best.turns, 'string_agg', chr(10)), '')) repaired_sha256
from chosen c left join counted d on d.conv_id is not distinct from c.conv_id"""


@query("op13_conversation_repair", _REPAIR)
def op13(spark: SparkSession, folder: str) -> DataFrame:
    rows = repair.damaged(table(spark, folder, "conversations"))
    rows = repair.judged(rows, "conv_id", "turn", "role", "text", F.col("present"), copy=F.col("copy"))
    return repair.summaries(rows).drop("most_held")
