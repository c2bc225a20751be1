"""The registered queries of the operators, with SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from shelfwise.llm import alignment, bagminhash, bwtmerge, cotraining, decontaminate, imatch, licenses, logbilinear, mixing, preference, sharding, stringkernel, turnrepair, wordruns
from shelfwise.operators.keys import lookup
from shelfwise.session import cut_lineage

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None):
    def register(run: Callable[[SparkSession, str], DataFrame]):
        QUERIES[name] = run
        if oracle:
            ORACLES[name] = oracle
        return run

    return register


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


_FOLD = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = rf"regexp_extract_all({_FOLD}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

OP1_SQL = f"""
WITH d AS (SELECT doc_id, coalesce({_WORDS}, []) AS w FROM documents),
i AS (SELECT CAST(item_id AS VARCHAR) AS item_id, {_WORDS} AS w FROM benchmark WHERE text IS NOT NULL AND item_id IS NOT NULL),
iw AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS n, array_to_string(list_slice(w, p, p + least(len(w), 10) - 1), ' ') AS g
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS p FROM i WHERE len(w) > 0)
),
lens AS (SELECT DISTINCT n FROM iw),
dp AS (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS p FROM d WHERE len(w) > 0),
dw AS (
  SELECT doc_id, p, n, array_to_string(list_slice(w, p, p + n - 1), ' ') AS g FROM dp JOIN lens ON p + n - 1 <= len(w)
),
hits AS (SELECT doc_id, p, dw.n, item_id FROM dw JOIN iw ON dw.g = iw.g AND dw.n = iw.n),
words AS (SELECT doc_id, count(DISTINCT q) AS n_hit FROM (SELECT doc_id, unnest(range(p, p + n)) AS q FROM hits) GROUP BY doc_id),
items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS ids
  FROM (SELECT DISTINCT doc_id, item_id FROM hits) GROUP BY doc_id
)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
  CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN words USING (doc_id) LEFT JOIN items USING (doc_id)
"""


@query("op1_decontaminate", OP1_SQL)
def op1_decontaminate(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    marked = decontaminate.mark(docs, table(spark, folder, "benchmark"), keep_text=False)
    covered = F.aggregate("hit_spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return marked.select(
        "doc_id",
        "n_words",
        covered.alias("n_hit"),
        F.size("hit_items").cast("long").alias("n_items"),
        F.sha2(F.array_join(F.array_sort("hit_items"), ",").cast("binary"), 256).alias("items_sha256"),
        (F.size("hit_spans") > 0).alias("contaminated"),
    )


@query("op3_sharding")
def op3_sharding(spark: SparkSession, folder: str) -> DataFrame:
    return sharding.shard_documents(table(spark, folder, "documents").select("doc_id", "text"))


OP6_SQL = """
WITH t AS (SELECT conv_id, turn, role, text FROM conversations WHERE conv_id IS NOT NULL),
last AS (SELECT conv_id, max(turn) AS last_turn FROM t WHERE role = 'assistant' GROUP BY conv_id),
reply AS (SELECT l.conv_id, l.last_turn, t.text FROM last l JOIN t ON t.conv_id = l.conv_id AND t.turn = l.last_turn AND t.role = 'assistant'),
b AS (
  SELECT t.conv_id, t.turn, t.role, coalesce(t.role, '') AS r, coalesce(t.text, '') AS chosen,
    CASE WHEN t.role = 'assistant' AND t.turn = reply.last_turn THEN coalesce(donor.text, '') ELSE coalesce(t.text, '') END AS rejected
  FROM t LEFT JOIN reply ON reply.conv_id = t.conv_id LEFT JOIN reply AS donor ON donor.conv_id = t.conv_id + 1
),
n AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn, role, chosen) AS k FROM b),
p AS (SELECT conv_id, coalesce(min(CASE WHEN chosen <> rejected THEN k END), count(*) + 1) - 1 AS n_prompt FROM n GROUP BY conv_id),
m AS (
  SELECT n.*, p.n_prompt,
    sum(CASE WHEN k > n_prompt THEN length(r) + length(chosen) + 24 ELSE 0 END) OVER (PARTITION BY n.conv_id ORDER BY k) AS a_end,
    sum(CASE WHEN k > n_prompt THEN length(r) + length(rejected) + 24 ELSE 0 END) OVER (PARTITION BY n.conv_id ORDER BY k) AS b_end
  FROM n JOIN p ON p.conv_id = n.conv_id
)
SELECT conv_id AS pair_id, CAST(max(n_prompt) AS INTEGER) AS n_prompt_turns,
  coalesce(string_agg(CASE WHEN k <= n_prompt THEN '<|im_start|>' || r || chr(10) || chosen || '<|im_end|>' || chr(10) END, '' ORDER BY k), '') AS prompt,
  coalesce(string_agg(CASE WHEN k > n_prompt THEN '<|im_start|>' || r || chr(10) || chosen || '<|im_end|>' || chr(10) END, '' ORDER BY k), '') AS chosen,
  coalesce(string_agg(CASE WHEN k > n_prompt THEN '<|im_start|>' || r || chr(10) || rejected || '<|im_end|>' || chr(10) END, '' ORDER BY k), '') AS rejected,
  coalesce(string_agg(CASE WHEN k > n_prompt AND role = 'assistant' THEN CAST(CAST(a_end - 11 - length(chosen) AS BIGINT) AS VARCHAR) || '-' || CAST(CAST(a_end - 1 AS BIGINT) AS VARCHAR) END, ',' ORDER BY k), '') AS chosen_mask,
  coalesce(string_agg(CASE WHEN k > n_prompt AND role = 'assistant' THEN CAST(CAST(b_end - 11 - length(rejected) AS BIGINT) AS VARCHAR) || '-' || CAST(CAST(b_end - 1 AS BIGINT) AS VARCHAR) END, ',' ORDER BY k), '') AS rejected_mask
FROM m GROUP BY conv_id
"""


@query("op6_preference", OP6_SQL)
def op6_preference(spark: SparkSession, folder: str) -> DataFrame:
    chosen, rejected = preference.swapped_replies(table(spark, folder, "conversations"))
    pairs = preference.format_pairs(chosen, rejected)
    as_text = lambda c: F.array_join(F.transform(c, lambda s: F.concat_ws("-", s["start"], s["end"])), ",")
    return pairs.select(
        "pair_id", "n_prompt_turns", "prompt", "chosen", "rejected",
        as_text("chosen_spans").alias("chosen_mask"), as_text("rejected_spans").alias("rejected_mask"),
    )


@query("op7_imatch")
def op7_imatch(spark: SparkSession, folder: str) -> DataFrame:
    found = imatch.compare_with_edited(table(spark, folder, "documents").select("doc_id", "text"))
    return found.select(
        "doc_id",
        F.char_length("text").cast("long").alias("n_chars"),
        F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        "fingerprint", "edited_fingerprint", "near_edited", "near_next",
    )


MIX_LEVELS = ("domain", "lang", "source")
MIX_WEIGHTS = {"domain": {"a": 3.0, "b": 2.0, "c": 1.0, "d": 1.0}, "lang": {"en": 4.0, "de": 2.0, "fr": 2.0, "es": 3.0}}
MIX_BUDGET, MIX_EPOCHS, MIX_SEED = 0.8, 2, 17


def with_domain(docs: DataFrame) -> DataFrame:
    """The tables name no domain: sources are dealt to four domains by their number."""
    number = F.coalesce(F.regexp_extract(F.coalesce("source", F.lit("")), "([0-9]{1,9})$", 1).try_cast("int"), F.lit(0))
    return docs.withColumn("domain", F.element_at(F.array(*map(F.lit, "abcd")), (number % 4 + 1).cast("int")))


OP8_SQL = """
WITH d AS (
  SELECT doc_id, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    substr('abcd', CAST(coalesce(TRY_CAST(regexp_extract(coalesce(source, ''), '([0-9]{1,9})$', 1) AS INTEGER), 0) % 4 + 1 AS INTEGER), 1) AS domain,
    CAST(len(regexp_extract_all(coalesce(text, ''), '[^ \\t\\n\\r]+')) AS BIGINT) AS tokens, md5(coalesce(text, '')) AS h
  FROM documents
),
r AS (SELECT d.*, epoch FROM d, (SELECT 1 AS epoch UNION ALL SELECT 2) WHERE tokens > 0),
o AS (SELECT r.*, md5('17:' || CAST(epoch AS VARCHAR) || ':' || coalesce(CAST(doc_id AS VARCHAR), '')) AS k FROM r),
l3 AS (SELECT domain, lang, source, CAST(sum(tokens) AS DOUBLE) AS capacity, 1.0::DOUBLE AS w FROM r GROUP BY ALL),
l2 AS (SELECT domain, lang, sum(capacity) AS capacity, CASE lang WHEN 'en' THEN 4.0 WHEN 'de' THEN 2.0 WHEN 'fr' THEN 2.0 WHEN 'es' THEN 3.0 ELSE 1.0 END::DOUBLE AS w FROM l3 GROUP BY ALL),
l1 AS (SELECT domain, sum(capacity) AS capacity, CASE domain WHEN 'a' THEN 3.0 WHEN 'b' THEN 2.0 ELSE 1.0 END::DOUBLE AS w FROM l2 GROUP BY ALL),
b0 AS (SELECT least(sum(capacity) / 2 * 0.8::DOUBLE, sum(capacity)) AS budget FROM l1),
s1 AS (
  SELECT l1.*, budget, coalesce(sum(capacity) OVER (ORDER BY capacity / w, domain ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before,
    sum(w) OVER (ORDER BY capacity / w, domain ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS after FROM l1, b0
),
f1 AS (SELECT *, capacity / w * after <= budget - before AS full_ FROM s1),
t1 AS (
  SELECT domain, CASE WHEN full_ THEN capacity ELSE least(capacity, w * (budget - coalesce(sum(CASE WHEN full_ THEN capacity END) OVER (), 0))
    / nullif(sum(CASE WHEN full_ THEN 0 ELSE w END) OVER (), 0)) END AS budget FROM f1
),
s2 AS (
  SELECT l2.*, budget, coalesce(sum(capacity) OVER (PARTITION BY domain ORDER BY capacity / w, lang ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before,
    sum(w) OVER (PARTITION BY domain ORDER BY capacity / w, lang ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS after FROM l2 JOIN t1 USING (domain)
),
f2 AS (SELECT *, capacity / w * after <= budget - before AS full_ FROM s2),
t2 AS (
  SELECT domain, lang, CASE WHEN full_ THEN capacity ELSE least(capacity, w * (budget - coalesce(sum(CASE WHEN full_ THEN capacity END) OVER (PARTITION BY domain), 0))
    / nullif(sum(CASE WHEN full_ THEN 0 ELSE w END) OVER (PARTITION BY domain), 0)) END AS budget FROM f2
),
s3 AS (
  SELECT l3.*, budget, coalesce(sum(capacity) OVER (PARTITION BY domain, lang ORDER BY capacity / w, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before,
    sum(w) OVER (PARTITION BY domain, lang ORDER BY capacity / w, source ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS after FROM l3 JOIN t2 USING (domain, lang)
),
f3 AS (SELECT *, capacity / w * after <= budget - before AS full_ FROM s3),
t3 AS (
  SELECT domain, lang, source, CASE WHEN full_ THEN capacity ELSE least(capacity, w * (budget - coalesce(sum(CASE WHEN full_ THEN capacity END) OVER (PARTITION BY domain, lang), 0))
    / nullif(sum(CASE WHEN full_ THEN 0 ELSE w END) OVER (PARTITION BY domain, lang), 0)) END AS target FROM f3
),
leaf AS (SELECT domain, lang, source, CAST(floor(round(target, 3)) AS BIGINT) AS target_tokens FROM t3),
c AS (
  SELECT o.*, target_tokens, sum(tokens) OVER (PARTITION BY o.domain, o.lang, o.source ORDER BY epoch, k, doc_id, tokens, h ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS upto
  FROM o JOIN leaf ON o.domain = leaf.domain AND o.lang = leaf.lang AND o.source = leaf.source
)
SELECT doc_id, domain, lang, source, CAST(epoch AS INTEGER) AS epoch, tokens, CAST(least(tokens, target_tokens - (upto - tokens)) AS BIGINT) AS take_tokens, target_tokens
FROM c WHERE target_tokens > upto - tokens
"""


@query("op8_mixing", OP8_SQL)
def op8_mixing(spark: SparkSession, folder: str) -> DataFrame:
    docs = with_domain(table(spark, folder, "documents").select("doc_id", "text", "lang", "source"))
    taken = mixing.mix(docs, MIX_LEVELS, MIX_WEIGHTS, MIX_BUDGET, MIX_EPOCHS, MIX_SEED)
    named = [F.coalesce(c, F.lit("")).alias(c) for c in MIX_LEVELS]
    return taken.select("doc_id", *named, "epoch", "tokens", "take_tokens", "target_tokens")


@query("op2_quality")
def op2_quality(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text", "lang", "source")
    scored = cotraining.score(docs, table(spark, folder, "labels"))
    names = ("content_score", "metadata_score", "quality_score")
    return scored.select(
        "doc_id", *[F.round(n, 6).alias(n) for n in names], (F.col("quality_score") >= cotraining.KEEP).alias("keep"),
        F.round("toxic_score", 6).alias("toxic_score"), (F.col("toxic_score") > cotraining.TOXIC).alias("toxic"),
    )


@query("op4_near_duplicates")
def op4_near_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    return bagminhash.classify(table(spark, folder, "documents").select("doc_id", "text"))


@query("op5_repeats")
def op5_repeats(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    found = cut_lineage(bwtmerge.repeated_spans(docs))
    shared = cut_lineage(wordruns.shared_words(bwtmerge.keyed(docs).select("dk", "text")))
    found = lookup(found, shared, "dk", ["doc_id", "kept_sha256"])
    removed = F.aggregate("removed", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return found.select("doc_id", "n_bytes", removed.alias("n_removed"), F.size("removed").cast("long").alias("n_spans"), "kept_sha256", F.coalesce("n_shared_words", F.lit(0)).cast("long").alias("n_shared_words"))


_TEMPLATE_ROWS = ", ".join(f"('{name}', {number}, '{text}')" for number, (name, text) in enumerate(licenses.TEMPLATES))
_DIGITLESS = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ123456789', 'abcdefghijklmnopqrstuvwxyz000000000')"
_PLAIN_WORDS = r"regexp_extract_all({}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

OP9_SQL = f"""
WITH t AS (SELECT name, nr, {_PLAIN_WORDS.format(_DIGITLESS.format("body"))} AS w FROM (VALUES {_TEMPLATE_ROWS}) AS v(name, nr, body)),
ts AS (
  SELECT DISTINCT name, nr, len(w) AS n_words, array_to_string(list_slice(w, p, p + 2), ' ') AS g
  FROM (SELECT *, unnest(range(1, greatest(len(w) - 1, 2))) AS p FROM t)
),
tc AS (
  SELECT name, nr, count(*) AS n, CASE WHEN max(n_words) <= 8 THEN 8 WHEN max(n_words) <= 16 THEN 16 WHEN max(n_words) <= 32 THEN 32 ELSE 64 END AS span
  FROM ts GROUP BY name, nr
),
d AS (SELECT doc_id, coalesce({_PLAIN_WORDS.format(_DIGITLESS.format("text"))}, []) AS w FROM documents),
ds AS (
  SELECT doc_id, p - 1 AS p, array_to_string(list_slice(w, p, p + 2), ' ') AS g
  FROM (SELECT *, unnest(range(1, greatest(len(w) - 1, 2))) AS p FROM d WHERE len(w) > 0)
),
met AS (SELECT DISTINCT doc_id, ts.name, ts.nr, ds.g, tc.n, p // span AS block FROM ds JOIN ts ON ds.g = ts.g JOIN tc ON tc.nr = ts.nr),
win AS (SELECT doc_id, name, nr, g, n, block FROM met UNION SELECT doc_id, name, nr, g, n, block - 1 FROM met WHERE block > 0),
held AS (SELECT doc_id, name, nr, block, n, count(DISTINCT g) AS c FROM win GROUP BY ALL),
best AS (SELECT doc_id, name, max(c / n) AS containment FROM held WHERE c >= ceil(0.8 * n - 1e-9) GROUP BY doc_id, name),
per AS (SELECT doc_id, count(*) AS n_licenses, string_agg(name, ',' ORDER BY name) AS licenses, max(containment) AS best_containment FROM best GROUP BY doc_id)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, CAST(coalesce(n_licenses, 0) AS BIGINT) AS n_licenses, coalesce(licenses, '') AS licenses,
  round(coalesce(best_containment, 0), 6) AS best_containment
FROM d LEFT JOIN per ON per.doc_id = d.doc_id
"""


@query("op9_licenses", OP9_SQL)
def op9_licenses(spark: SparkSession, folder: str) -> DataFrame:
    found = licenses.scan(table(spark, folder, "documents").select("doc_id", "text")).drop("text")
    return found.select(
        "doc_id",
        "n_words",
        F.size("matches").cast("long").alias("n_licenses"),
        F.array_join(F.transform("matches", lambda m: m["license"]), ",").alias("licenses"),
        F.round(F.coalesce(F.array_max(F.transform("matches", lambda m: m["containment"])), F.lit(0.0)), 6).alias("best_containment"),
    )


@query("op10_language_model")
def op10_language_model(spark: SparkSession, folder: str) -> DataFrame:
    return logbilinear.score(table(spark, folder, "documents").select("doc_id", "text"))


@query("op11_alignment")
def op11_alignment(spark: SparkSession, folder: str) -> DataFrame:
    documents, _ = alignment.align(table(spark, folder, "documents"))
    return documents


@query("op12_language")
def op12_language(spark: SparkSession, folder: str) -> DataFrame:
    found = stringkernel.identify(table(spark, folder, "documents").select("doc_id", "text", "lang"), keep_text=False)
    return found.select("doc_id", "held_out", "lang_pred", F.round("score", 6).alias("score"))


def _reached(state: str, cost: str = "0", letter: str = "", line: str = "''") -> str:
    return f"{{'c': {state}.c + {cost}, 'a': {state}.a || '{letter}', 't': {state}.t || {line}}}"


def _cheapest(*ways: str) -> str:
    return f"list_sort([{', '.join(ways)}])[1]"


_TURN = "chr(10) || '{}:' || text"
_STAY = "CASE WHEN gone THEN 1000000000 WHEN truncated THEN 5 ELSE 0 END"
_KEEP = lambda state, role: _reached(state, f"(CASE WHEN i = '{role}' THEN {_STAY} ELSE 1000000000 END)", "K", "chr(10) || role || ':' || text")
_REROLE = lambda state, role: _reached(state, f"1 + ({_STAY})", "R", _TURN.format(role))
_INSERT = lambda state, role: _reached(state, "5", "I", f"chr(10) || '{role}:'")
_AFTER_ROW = [
    _reached("s0", "2", "D"),
    _cheapest(_reached("s1", "2", "D"), _KEEP("s0", "s")),
    _cheapest(_reached("s2", "2", "D"), *[_KEEP(s, "u") for s in ("s0", "s1", "s3")], *[_REROLE(s, "user") for s in ("s0", "s1", "s3")]),
    _cheapest(_reached("s3", "2", "D"), _KEEP("s2", "a"), _REROLE("s2", "assistant")),
]
_SPACES = r"\x20\x09-\x0D"

OP13_SQL = f"""
WITH RECURSIVE
crc AS (
  SELECT list(v ORDER BY i) AS t FROM (
    SELECT i, list_reduce(list_prepend(i, range(8)), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS v FROM range(256) AS r(i))
),
keyed AS (
  SELECT conv_id, coalesce('=' || CAST(conv_id AS VARCHAR), '') AS conv, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    list_transform(string_split(coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' '), ''), lambda x: CAST(ord(x) AS BIGINT)) AS b
  FROM conversations
),
kinds AS (
  SELECT keyed.*, xor(list_reduce(list_prepend(4294967295, b), lambda c, x: xor(c >> 8, t[(xor(c, x) & 255) + 1])), 4294967295) % 20 AS kind FROM keyed, crc
),
d AS (
  SELECT conv, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
    CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
  FROM kinds, range(2) AS copies(copy) WHERE kind <> 0 AND (copy = 0 OR kind = 3)
),
n AS (SELECT *, row_number() OVER (PARTITION BY conv ORDER BY turn NULLS FIRST, role, text) AS k, substr(role, 1, 1) AS i FROM d),
f AS (
  SELECT n.*, NOT regexp_matches(text, '[^{_SPACES}]') AS blank, row_number() OVER (PARTITION BY conv, role, text ORDER BY k) > 1 AS again,
    NOT regexp_matches(text, '[.!?][{_SPACES}]*$') AS cut, i || lead(i) OVER (PARTITION BY conv ORDER BY k) AS pair
  FROM n
),
r AS (SELECT *, blank OR again AS gone, cut AS truncated FROM f),
ends AS (
  SELECT conv, max(k) AS last, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count_if(blank) AS blank,
    count_if(again AND NOT blank) AS duplicate, count_if(cut AND NOT blank AND NOT again) AS truncated, count_if(pair NOT IN ('su', 'ua', 'au')) AS illegal
  FROM f GROUP BY conv
),
dp AS (
  SELECT conv, 0 AS k, {{'c': 0, 'a': '', 't': ''}} AS s0, {{'c': 1000000000, 'a': '', 't': ''}} AS s1,
    {_INSERT("{'c': 0, 'a': '', 't': ''}", "user")} AS s2, {{'c': 10, 'a': 'II', 't': chr(10) || 'user:' || chr(10) || 'assistant:'}} AS s3
  FROM ends
  UNION ALL
  SELECT conv, k, b0, b1, u, {_cheapest("b3", _INSERT("u", "assistant"))}
  FROM (SELECT *, {_cheapest("b2", *[_INSERT(s, "user") for s in ("b0", "b1", "b3")])} AS u
    FROM (SELECT r.conv, CAST(r.k AS INTEGER) AS k, {", ".join(f"{way} AS b{s}" for s, way in enumerate(_AFTER_ROW))} FROM dp JOIN r ON r.conv = dp.conv AND r.k = dp.k + 1))
),
done AS (SELECT dp.conv, ends.* EXCLUDE (conv), {_cheapest("s0", "s3")} AS best FROM dp JOIN ends ON ends.conv = dp.conv AND dp.k = ends.last),
everyone AS (SELECT DISTINCT conv, conv_id FROM keyed)
SELECT conv_id, CAST(coalesce(gaps, 0) AS BIGINT) AS gaps, CAST(coalesce(blank, 0) AS BIGINT) AS blank, CAST(coalesce(duplicate, 0) AS BIGINT) AS duplicate,
  CAST(coalesce(truncated, 0) AS BIGINT) AS truncated, CAST(coalesce(illegal, 0) AS BIGINT) AS illegal, CAST(coalesce(best.c, 0) AS BIGINT) AS cost,
  coalesce(best.a, '') AS audit, sha256(substr(coalesce(best.t, ''), 2)) AS repaired_sha256
FROM everyone LEFT JOIN done ON done.conv = everyone.conv
"""


@query("op13_turn_repair", OP13_SQL)
def op13_turn_repair(spark: SparkSession, folder: str) -> DataFrame:
    return turnrepair.repair_damaged(table(spark, folder, "conversations"))
