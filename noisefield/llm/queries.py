"""The queries of this subpackage: each applies its operator to the whole table and derives the columns asked for."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from . import chat, divergence, fingerprints, lengths, mixing, near, packing, periods, quality, shards, suffix, tokenfile, toxicity

TOKENIZER = "word_bpe_49k.json"


def _docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


# 1 ---------------------------------------------------------------------------------------------------------------

MIX_WEIGHTS = {("domain0",): 2.0, ("domain3",): 0.5, ("domain1", "en"): 4.0, ("domain2", "fr", "src2"): 0.5}
MIX_SHARE, MIX_EPOCHS, MIX_SEED = 0.8, 4, 7


def op1_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    levels = {"domain": mixing.source_domain(F.col("source")), "lang": F.col("lang"), "source": F.col("source")}
    return mixing.mix(_docs(spark, sf_dir), MIX_SHARE, MIX_WEIGHTS, MIX_EPOCHS, MIX_SEED, levels)


def _mix_level_sql(depth: int) -> str:
    """One level of the budget tree as SQL."""
    names = list(mixing.LEVELS)
    path, up = names[:depth], names[: depth - 1]
    cases = " ".join(f"when {' and '.join(f"{c} = '{v}'" for c, v in zip(path, k, strict=True))} then {w}" for k, w in MIX_WEIGHTS.items() if len(k) == depth)
    weight = f"case {cases} else 1.0 end::double" if cases else "1.0::double"
    cols, part = ", ".join(path), f"partition by {', '.join(up)}" if up else ""
    total = f"floor(sum(tokens) over () * {MIX_SHARE}::double)" if not up else "parent_budget"
    source = f"(select {cols}, sum(tokens)::double tokens, sum(tokens)::double * {MIX_EPOCHS} cap from leaves group by all)"
    joined = f"(select n.*, p.budget parent_budget from {source} n join b{depth - 1} p using ({', '.join(up)}))" if up else source
    order = f"order by ratio, {path[-1]}"
    return f"""
    b{depth} as (
      with w as (select *, {weight} weight, {total} parent_budget_ from {joined}),
      r as (select * replace (cap / weight as ratio) from (select *, 0.0::double ratio from w)),
      l as (select *, (parent_budget_ - coalesce(sum(cap) over ({part} {order} rows between unbounded preceding and 1 preceding), 0))
                      / sum(weight) over ({part} {order} rows between current row and unbounded following) lev from r),
      m as (select *, max(case when ratio > lev then lev end) over ({part}) lam from l),
      s as (select *, case when lam is null or ratio <= lam then cap else lam * weight end share_ from m),
      f as (select *, floor(share_) base from s),
      t as (select *, least(parent_budget_, sum(cap) over ({part})) - sum(base) over ({part}) rest_,
                   row_number() over ({part} order by (base >= cap)::int, share_ - base desc, {path[-1]}) turn from f)
      select {cols}, tokens, base + case when turn <= rest_ and base < cap then 1 else 0 end budget from t)"""


MIX_SQL = f"""
with rows_ as (
  select doc_id, coalesce(case when regexp_extract(source, '(\\d+)$', 1) <> '' then 'domain' || (regexp_extract(source, '(\\d+)$', 1)::bigint % 4)::varchar end, '(none)') as domain,
         coalesce(lang, '(none)') lang, coalesce(source, '(none)') source,
         coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0)::bigint n_tokens from documents),
leaves as (select domain, lang, source, sum(n_tokens)::double tokens from rows_ group by all),
{",".join(_mix_level_sql(d) for d in (1, 2, 3))},
plan_ as (select domain, lang, source, (case when tokens > 0 then floor(budget / tokens) else 0 end)::bigint epochs, tokens, budget from b3),
k as (select r.*, p.epochs, (p.budget - p.epochs * p.tokens)::bigint rest_, md5('{MIX_SEED}:' || p.epochs || ':' || r.doc_id) order_key
      from rows_ r join plan_ p using (domain, lang, source)),
a as (select *, coalesce(sum(n_tokens) over (partition by domain, lang, source order by order_key, n_tokens rows between unbounded preceding and 1 preceding), 0) ahead from k),
t as (select *, greatest(0, least(n_tokens, rest_ - ahead))::bigint last_tokens from a)
select doc_id, domain, lang, source, n_tokens, epochs, last_tokens, (epochs * n_tokens + last_tokens)::bigint tokens_taken from t
"""

# 2 ---------------------------------------------------------------------------------------------------------------


def op2_format_chats(spark: SparkSession, sf_dir: str) -> DataFrame:
    probe = spark.sql("select -1L conv_id, id turn, if(id = 0, 'user', 'assistant') role, '</s>[INST] ok [/INST]' text from range(2)")
    turns = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text").unionByName(probe)
    made = chat.format_chats(turns.withColumn("parts", chat.text_parts(F.col("text"))))
    back = made.withColumn("back", chat.read_turns(F.col("formatted"))).withColumn("loss", chat.read_loss(F.col("formatted"), F.col("loss_spans")))
    digest = F.concat_ws("", F.transform("back", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))))
    return back.select(
        "conv_id",
        F.size("back").cast("long").alias("n_turns"),
        F.sha2(digest, 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"),
        F.sha2("loss", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
        F.size("attachments").cast("long").alias("n_attachments"),
        "expanded_tokens",
    )


def _escaped_sql(x: str) -> str:
    out = f"replace({x}, '\\', '\\\\')"
    for c in chat.CONTROLS:
        out = f"replace({out}, '{c}', '{c[0]}\\{c[1:]}')"
    return out


CHAT_SQL = f"""
with t as (
  select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
  union all select -1, 0, 'user', '</s>[INST] ok [/INST]' union all select -1, 1, 'assistant', '</s>[INST] ok [/INST]')
select conv_id, count(*)::bigint n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn, role, text)) turns_sha256,
  coalesce(sum(length(text)) filter (role = 'assistant'), 0)::bigint loss_chars,
  sha256(coalesce(string_agg(text, '' order by turn, role, text) filter (role = 'assistant'), '')) loss_sha256,
  sum({len(chat.TURN) + len(chat.BODY) + len(chat.END)} + length({_escaped_sql("role")}) + length({_escaped_sql("text")}))::bigint formatted_chars,
  0::bigint n_attachments, sum(ceil(length(text) / {chat.CHARS_PER_TOKEN}))::bigint expanded_tokens
from t group by conv_id
"""

# 3 ---------------------------------------------------------------------------------------------------------------


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = quality.judge(quality.measure(_docs(spark, sf_dir)))
    return m.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "dup_line_chars", *(f"rep_{n}" for n in quality.NGRAM_LIMITS), *(f"win_{n}" for n in quality.SHORT))


def _quality_sql() -> str:
    sizes = sorted(quality.NGRAM_LIMITS)
    most = max(sizes)
    short, width = quality.SHORT, quality.WINDOW_WORDS
    leads = "".join(f", lead(w, {k}) over (partition by rid order by i) w{k}" for k in range(1, most))
    gram = "".join(f", case when w{n - 1} is not null then hash(concat_ws(' ', {', '.join(f'w{k}' for k in range(n))})) end g{n}" for n in sizes)
    # a gram lies inside a window if its last word does
    inside = "".join(f", case when (i + {n - 2}) // {width} = win then g{n} end h{n}" for n in short)
    twice = "".join(f", case when g{n} is not null and count(*) over (partition by doc_id, g{n}) > 1 then i end t{n}" for n in sizes)
    twice += "".join(f", case when h{n} is not null and count(*) over (partition by doc_id, win, h{n}) > 1 then i end u{n}" for n in short)
    cover = "".join(f", coalesce(i - max(t{n}) over (partition by doc_id order by i rows between unbounded preceding and current row) < {n}, false) c{n}" for n in sizes)
    cover += "".join(f", coalesce(i - max(u{n}) over (partition by doc_id, win order by i rows between unbounded preceding and current row) < {n}, false) d{n}" for n in short)
    rep = "".join(f", coalesce(sum(length(w)) filter (c{n}), 0)::bigint rep_{n}" for n in sizes) + "".join(f", coalesce(sum(length(w)) filter (d{n}), 0)::bigint win_{n}" for n in short)
    held = [f"rep_{n}" for n in sizes] + [f"win_{n}" for n in short]
    good = "".join(f" and {'win' if n in short else 'rep'}_{n} <= {m} * word_chars" for n, m in quality.NGRAM_LIMITS.items())
    return f"""
with d as (select row_number() over () rid, doc_id, coalesce(text, '') as text from documents),
e as (select rid, doc_id, text, regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+') ws from d),
w as (select rid, unnest(ws) w, unnest(range(1, len(ws) + 1)) i from e),
v as (select rid as doc_id, w, w as w0, i, (i - 1) // {width} win{leads} from w),
g as (select doc_id, w, i, win{gram} from v),
h as (select *{inside} from g),
t as (select doc_id, w, i, win{twice} from h),
c as (select doc_id, w{cover} from t),
s as (select doc_id rid, count(*) filter (c5) n_repeat_words{rep} from c group by doc_id),
l as (select rid, n, line from (select rid, unnest(string_split(text, chr(10))) line, unnest(range(1, len(string_split(text, chr(10))) + 1)) n from e)
      where regexp_matches(line, '[^\\x20\\x09-\\x0D]')),
r as (select rid, line, row_number() over (partition by rid, line order by n) k from l),
q as (select rid, count(*) filter (k > 1) n_dup_lines, coalesce(sum(length(regexp_replace(line, '[\\x20\\x09-\\x0D]', '', 'g'))) filter (k > 1), 0) dup_line_chars from r group by rid),
x as (select doc_id, len(ws)::bigint n_words, length(regexp_replace(text, '[\\x20\\x09-\\x0D]', '', 'g'))::bigint word_chars,
      length(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::bigint n_symbols, coalesce(n_dup_lines, 0)::bigint n_dup_lines,
      coalesce(n_repeat_words, 0)::bigint n_repeat_words, coalesce(dup_line_chars, 0)::bigint dup_line_chars{"".join(f", coalesce({c}, 0)::bigint {c}" for c in held)}
      from e left join s using (rid) left join q using (rid)),
y as (select *, (n_words < 10 or 100 * n_repeat_words > 20 * n_words) base_failed from x)
select *, (not base_failed and dup_line_chars <= {quality.LINE_LIMIT} * word_chars{good}) kept from y
"""


# 4 ---------------------------------------------------------------------------------------------------------------


def op4_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.fingerprints(_docs(spark, sf_dir))


# 5 ---------------------------------------------------------------------------------------------------------------


def op5_toxicity_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _docs(spark, sf_dir)
    labels = toxicity.categories_of(spark.read.parquet(f"{sf_dir}/labels.parquet"))
    out = toxicity.score(docs, toxicity.train(docs, labels))
    return out.withColumn("toxic", F.col("p_toxic") >= toxicity.THRESHOLD)


# 6, 8, 10 --------------------------------------------------------------------------------------------------------


def op6_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.best_two_fit(_docs(spark, sf_dir), public_tokenizers.path(TOKENIZER))


def op8_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = shards.shard_documents(_docs(spark, sf_dir), 16)
    return out.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


#: Context limits and shares that the report answers besides every length that occurs.
LIMITS, SHARES = [2**k for k in range(7, 18)], [0.01, 0.05, 0.25, 0.5, 0.75, 0.9, 0.95, 0.99, 1.0]


def op10_token_lengths(spark: SparkSession, sf_dir: str) -> DataFrame:
    counted = lengths.encoded_lengths(_docs(spark, sf_dir), public_tokenizers.path(TOKENIZER))
    report = lengths.suffix_report(lengths.histogram(counted))
    no_share = F.lit(None).cast("double").alias("share")
    rows = report.select(F.lit("length").alias("kind"), no_share, "*")
    rows = rows.unionByName(lengths.at_limits(report, LIMITS).select(F.lit("limit").alias("kind"), no_share, "*"))
    return rows.unionByName(lengths.quantiles(report, SHARES).select(F.lit("quantile").alias("kind"), "*"))


# 7 ---------------------------------------------------------------------------------------------------------------


def op7_cut_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = suffix.Repeats(_docs(spark, sf_dir)).report()
    return out.select(F.col("id").alias("doc_id"), "n_bytes", "n_removed", "n_spans", "kept_sha256")


REPEATS_SQL = """
with d as (select doc_id, hex(encode(coalesce(text, ''))) h from documents),
w as (select doc_id, p, substr(h, 2 * p + 1, 100) s from (select doc_id, h, unnest(range(0, (length(h) // 2 - 49)::bigint)) p from d)),
m as (select doc_id, p, min(doc_id) over (partition by s) least from w),
g as (select doc_id, p, case when p > lag(p, 1, -99) over (partition by doc_id order by p) + 50 then 1 else 0 end new from m where least < doc_id),
r as (select doc_id, p, sum(new) over (partition by doc_id order by p) k from g),
s as (select doc_id, k, min(p) a, max(p) + 50 z from r group by all),
c as (select doc_id, count(*) n_spans, sum(z - a) n_removed, max(z) last from s group by all),
t as (select s.doc_id, s.a, substr(h, (2 * lag(z, 1, 0) over (partition by s.doc_id order by a) + 1)::bigint, (2 * (a - lag(z, 1, 0) over (partition by s.doc_id order by a)))::bigint) piece from s join d using (doc_id)),
k as (select doc_id, string_agg(piece, '' order by a) pieces from t group by doc_id)
select d.doc_id, (length(h) // 2)::bigint n_bytes, coalesce(n_removed, 0)::bigint n_removed, coalesce(n_spans, 0)::bigint n_spans,
  sha256(unhex(coalesce(pieces || substr(h, (2 * last + 1)::bigint), h))) kept_sha256
from d left join c on c.doc_id = d.doc_id left join k on k.doc_id = d.doc_id
"""


# 9 ---------------------------------------------------------------------------------------------------------------


def op9_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near.near_duplicates(_docs(spark, sf_dir), words_each=4, percent=80)
    return found.withColumn("kept", F.expr("doc_id <=> component_id"))


NEAR_SQL = """
with recursive w as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') ws from documents),
u as (select doc_id, len(ws) n, unnest(ws) w, unnest(range(1, len(ws) + 1)) i from w),
v as (select doc_id, n, i, concat_ws(' ', w, lead(w, 1) over d, lead(w, 2) over d, lead(w, 3) over d) sh from u window d as (partition by doc_id order by i)),
sh as (select distinct doc_id, md5_number(sh) sh from v where i <= greatest(n - 3, 1)),
c as (select doc_id, count(*) n from sh group by doc_id),
p as (select a.doc_id a, b.doc_id b, count(*) k from sh a join sh b on a.sh = b.sh and a.doc_id < b.doc_id group by all),
l as (select a, b from p join c x on x.doc_id = a join c y on y.doc_id = b where 100 * k >= 80 * (x.n + y.n - k)),
e as (select a, b from l union all select b, a from l),
r(a, b) as (select doc_id, doc_id from documents union select r.a, e.b from r join e on r.b = e.a)
select d.doc_id, coalesce(c.n, 0)::bigint n_shingles, m.component_id, d.doc_id = m.component_id kept
from documents d left join c on c.doc_id = d.doc_id join (select a, min(b) component_id from r group by a) m on m.a = d.doc_id
"""


# 11 --------------------------------------------------------------------------------------------------------------


def op11_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(_docs(spark, sf_dir))


DIVERGENCE_SQL = """
with d as (
  select row_number() over () r, coalesce(lang, '') lang, coalesce(source, '') source,
         translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') t from documents),
w as (select r, lang, source, unnest(regexp_extract_all(t, '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) term from d),
c as (select lang, source, term, count(*) n, count(distinct r) docs from w group by all),
k as (select lang, term, sum(n) total from c group by all having sum(docs) >= 10),
v as (select lang, count(*) v, sum(total) whole from k group by all),
g as (select distinct lang, source from d),
a as (select g.lang, g.source, k.term, k.total, coalesce(c.n, 0) n from g join k on k.lang = g.lang left join c on c.lang = g.lang and c.source = g.source and c.term = k.term),
s as (select lang, source, sum(n) own from a group by all),
p as (select a.lang, a.source, a.term, a.n, 1 + 1000000000::hugeint * (a.n + 2) // (own + 2 * v) p, 1 + 1000000000::hugeint * (total + 2) // (whole + 2 * v) q
      from a join s on s.lang = a.lang and s.source = a.source join v on v.lang = a.lang),
f as (select x.lang, x.source, y.source item, sum((x.p - y.p) * (x.p - y.p) // (x.p + y.p)) value from p x join p y on x.lang = y.lang and x.term = y.term and x.source <> y.source group by all),
o as (select x.lang, x.source, 'pair' part, y.source item, coalesce(value, 0)::bigint value from g x join g y on x.lang = y.lang and x.source <> y.source
      left join f on f.lang = x.lang and f.source = x.source and f.item = y.source
      union all select lang, source, 'term', term, ((p - q) * (p - q) // (p + q))::bigint from p where n > 0 and p > q),
z as (select *, row_number() over (partition by lang, source, part order by value desc, item)::int rank from o)
select * from z where part = 'pair' or rank <= 10
"""


# 12 --------------------------------------------------------------------------------------------------------------


def planted(docs: DataFrame) -> DataFrame:
    """doc_id and text, where one document in ten is periodic from some word on, all of it set by the check sum of its id (of a null id: by 0)."""
    h = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary"))
    words = F.filter(F.split("text", r"[\x20\x09-\x0D]+"), lambda w: w != "")
    rows = docs.select("doc_id", "text", F.floor(h / 10).alias("g"), F.when(h % 10 == 0, words).alias("words")).withColumn("n", F.size("words"))
    rows = rows.withColumn("a", F.when(F.col("n") > 0, F.col("g") % F.col("n"))).withColumn("p", F.floor((F.col("n") - F.col("a")) / (F.col("g") % 8 + 3)) + 1)
    source = lambda i: F.when(i >= F.col("a"), F.col("a") + (i - F.col("a")) % F.col("p")).otherwise(i)
    made = F.array_join(F.transform(F.sequence(F.lit(0), F.col("n") - 1), lambda i: F.get("words", source(i).cast("int"))), " ")
    return rows.select("doc_id", F.when(F.col("n") > 0, made).otherwise(F.col("text")).alias("text"))


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periods.periodic_runs(planted(_docs(spark, sf_dir))).withColumn("best", periods.strongest(F.col("runs")))
    lines = F.transform("runs", lambda r: F.concat(r["start"], F.lit(","), r["length"], F.lit(","), r["period"], F.lit("\n")))
    of = F.col("best")
    return found.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), of["start"].alias("start"), of["length"].alias("length"), of["period"].alias("period"),
        F.call_function("div", of["length"] * 1000, of["period"]).alias("exponent_milli"), F.sha2(F.array_join(lines, "").cast("binary"), 256).alias("runs_sha256"), F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )


# Equal windows of eight words at two places i and i + q; stretches of such i are runs of period q, the smallest of those that share start and length.
PERIODS_SQL = """
with t as (select doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') ws,
             list_prepend(4294967295, flatten(list_transform(string_split(doc_id::varchar, ''), lambda x: [ascii(x)::bigint, -1, -1, -1, -1, -1, -1, -1, -1]))) bits from documents),
h as (select doc_id, ws, len(ws) n, xor(4294967295, list_reduce(bits, lambda c, x: case when x >= 0 then xor(c, x) when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end)) h from t),
g as (select *, h // 10 g, (h // 10) % greatest(n, 1) a from h),
m as (select doc_id, n, case when h % 10 = 0 and n > 0 then list_transform(range(n), lambda i: ws[1 + case when i >= a then a + (i - a) % (1 + (n - a) // (3 + g % 8)) else i end]) else ws end ws from g),
w as (select doc_id, unnest(ws) w, unnest(range(n)) i from m),
k as (select doc_id, n, i, md5_number(concat_ws(' ', w, lead(w, 1) over d, lead(w, 2) over d, lead(w, 3) over d, lead(w, 4) over d, lead(w, 5) over d, lead(w, 6) over d, lead(w, 7) over d)) key
      from w join (select doc_id, n from m) using (doc_id) window d as (partition by doc_id order by i)),
e as (select x.doc_id, x.i, y.i - x.i q from k x join k y on x.doc_id = y.doc_id and x.key = y.key and x.i < y.i where x.i + 8 <= x.n and y.i + 8 <= y.n and 3 * (y.i - x.i) <= x.n),
s as (select doc_id, q, i - row_number() over (partition by doc_id, q order by i) island, i from e),
r as (select doc_id, q, min(i) start, count(*) + 7 + q length from s group by doc_id, q, island having count(*) + 7 + q >= greatest(24, 3 * q)),
u as (select doc_id, start, length, min(q) period from r group by doc_id, start, length),
b as (select doc_id, count(*) n_runs, string_agg(start || ',' || length || ',' || period || chr(10), '' order by start, period) lines from u group by doc_id),
o as (select *, row_number() over (partition by doc_id order by length / period desc, start, period) k from u),
x as (select w.doc_id, w.i, w.w from w left join u on u.doc_id = w.doc_id and w.i >= u.start + u.period and w.i < u.start + u.length group by all having count(u.start) = 0),
c as (select doc_id, string_agg(w, ' ' order by i) kept from x group by doc_id)
select m.doc_id, coalesce(n_runs, 0)::bigint n_runs, start::bigint start, length::bigint length, period::bigint period, (1000 * length // period)::bigint exponent_milli,
  sha256(coalesce(lines, '')) runs_sha256, sha256(coalesce(kept, '')) collapsed_sha256
from m left join b on b.doc_id = m.doc_id left join o on o.doc_id = m.doc_id and o.k = 1 left join c on c.doc_id = m.doc_id
"""


# 13 --------------------------------------------------------------------------------------------------------------

FILE_TOKENIZER, FILE_END = "byte_bpe_50k.json", 2


def op13_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    read = tokenfile.token_files(_docs(spark, sf_dir), public_tokenizers.path(FILE_TOKENIZER), FILE_END)
    return read.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_mix_sources": op1_mix_sources,
        "op2_format_chats": op2_format_chats,
        "op3_quality_rules": op3_quality_rules,
        "op4_fingerprints": op4_fingerprints,
        "op5_toxicity_chain": op5_toxicity_chain,
        "op6_pack": op6_pack,
        "op7_cut_repeats": op7_cut_repeats,
        "op8_shards": op8_shards,
        "op9_near_duplicates": op9_near_duplicates,
        "op10_token_lengths": op10_token_lengths,
        "op11_source_divergence": op11_source_divergence,
        "op12_periodic_runs": op12_periodic_runs,
        "op13_token_files": op13_token_files,
    }


def oracle_sql() -> dict[str, str]:
    return {"op1_mix_sources": MIX_SQL, "op2_format_chats": CHAT_SQL, "op3_quality_rules": _quality_sql(), "op7_cut_repeats": REPEATS_SQL, "op9_near_duplicates": NEAR_SQL, "op11_source_divergence": DIVERGENCE_SQL, "op12_periodic_runs": PERIODS_SQL}
