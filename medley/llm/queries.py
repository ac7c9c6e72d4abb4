"""The queries of the training-data operators and, where SQL can say it, their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from . import chat_quotes, cotraining, decontaminate, fill_in_middle, filter_audit, mixing, ngram_join, pii, quality_rules, secret_scan, token_counts, warc, wavelet
from ._shared import table


def op1_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.secret_report(table(spark, sf_dir, "documents"))


def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixing_report(table(spark, sf_dir, "documents"))


def op3_wavelet_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return wavelet.token_report(table(spark, sf_dir, "documents"))


def op4_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.personal_report(table(spark, sf_dir, "documents"))


def op5_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.matches(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op6_quotation_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat_quotes.linked(table(spark, sf_dir, "conversations"))


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.quality_report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op8_cotraining(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cotraining.scored(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op9_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.jaccard_report(table(spark, sf_dir, "documents"))


def op10_warc_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archive_report(table(spark, sf_dir, "pages"))


def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit_report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op12_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_report(table(spark, sf_dir, "documents"))


def op13_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fill_in_middle.middle_report(table(spark, sf_dir, "documents"))


QUERIES = {
    "op1_secret_scan": op1_secret_scan,
    "op2_mixing": op2_mixing,
    "op3_wavelet_tokens": op3_wavelet_tokens,
    "op4_pii": op4_pii,
    "op5_decontaminate": op5_decontaminate,
    "op6_quotation_links": op6_quotation_links,
    "op7_quality_rules": op7_quality_rules,
    "op8_cotraining": op8_cotraining,
    "op9_ngram_join": op9_ngram_join,
    "op10_warc_index": op10_warc_index,
    "op11_filter_audit": op11_filter_audit,
    "op12_token_counts": op12_token_counts,
    "op13_fill_in_middle": op13_fill_in_middle,
}


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _secret_sql() -> str:
    parts = []
    for i, r in enumerate(secret_scan.RULES):
        # a look behind and runs taken whole are said with the character before, which is no part of the span
        behind = r.pattern.startswith("(?<![")
        plain = r.pattern.replace("}+", "}")
        p = _quoted("(^|[^" + plain[5:].replace("])", "])(", 1) + ")" if behind else plain)
        lead, more = ("length(b[j+1])", f", regexp_extract_all(t, {p}, 1) AS b") if behind else ("0", "")
        parts.append(
            f"""SELECT doc_id, {i} AS rank, {_quoted(r.kind)} AS kind,
  unnest(list_transform(range(len(m)), lambda j: {{'s': list_sum([length(x) FOR x IN p[1:j+1]])::BIGINT + coalesce(list_sum([length(x) FOR x IN m[1:j]]), 0)::BIGINT + {lead}, 'n': length(m[j+1]) - {lead}, 'g': length(g[j+1])}})) AS f
FROM (SELECT doc_id, string_split_regex(t, {p}) AS p, regexp_extract_all(t, {p}) AS m, regexp_extract_all(t, {p}, {r.group}) AS g{more} FROM d WHERE regexp_matches(t, {p}))"""
        )
    least = "CASE rank " + " ".join(f"WHEN {i} THEN {r.least}" for i, r in enumerate(secret_scan.RULES)) + " END"
    n = lambda kind: f"count(*) FILTER (WHERE kind = '{kind}')"
    return f"""WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
raw AS ({" UNION ALL ".join(parts)}),
hits AS (SELECT doc_id, rank, kind, f.s AS s, concat_ws(':', kind, f.s::VARCHAR, (f.s + f.n)::VARCHAR) AS v FROM raw WHERE f.g >= {least}),
per AS (SELECT doc_id, {n("assign")} AS n_assign, {n("access")} AS n_access, {n("hex")} AS n_hex,
  string_agg(v, ',' ORDER BY s, rank) FILTER (WHERE rank < {len(secret_scan.BASE)}) AS base, string_agg(v, ',' ORDER BY s, rank) AS spans FROM hits GROUP BY doc_id)
SELECT d.doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
  sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans FROM d LEFT JOIN per USING (doc_id)"""


WARC_SQL = """WITH p AS (SELECT page_id, strlen(coalesce(html, '')) AS n, sha256(coalesce(html, '')) AS h FROM pages),
f AS (SELECT h, min(page_id) AS first FROM p WHERE n >= 100 GROUP BY h)
SELECT page_id, n AS payload_bytes, p.h AS payload_digest, CASE WHEN page_id > first THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN page_id > first THEN first END AS refers_to
FROM p LEFT JOIN f ON p.h = f.h AND n >= 100"""

JACCARD_SQL = """WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
s AS (SELECT doc_id, list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [w] ELSE list_transform(range(1, len(w) - 3), lambda i: w[i:i+4]) END) AS s FROM w),
n AS (SELECT doc_id, len(s) AS n FROM s),
x AS (SELECT doc_id, unnest(s) AS g FROM s),
k AS (SELECT doc_id, g FROM x WHERE g IN (SELECT g FROM x GROUP BY g HAVING count(*) > 1)),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM k a JOIN k b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL),
l AS (SELECT a, b FROM p JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b WHERE 100 * c >= 80 * (na.n + nb.n - c)),
e AS (SELECT a, b FROM l UNION SELECT b, a FROM l),
r(doc_id, m) AS (SELECT doc_id, doc_id FROM n UNION SELECT e.b, r.m FROM r JOIN e ON e.a = r.doc_id WHERE r.m < e.b)
SELECT n.doc_id, n.n AS n_shingles, min(m) AS component_id FROM n JOIN r USING (doc_id) GROUP BY ALL"""



def _mixing_sql(gain: float = 0.5, most: float = 4.0, seed: int = 42) -> str:
    order = lambda n, *cols: f"('0x' || substr(md5(concat_ws('|', '{seed + n}', {', '.join(cols)})), 1, 15))::UBIGINT::BIGINT"
    sums = lambda e: (f"list_sum(list_transform(l, lambda x: pow(x, {e})))", f"list_sum(list_transform(l, lambda x: pow(x, {e}) * ln(x)))")

    def met(e: str) -> str:
        z, zl = sums(e)
        return f"(ln({z}) - {e} * {zl} / {z} <= target + 1e-12 AND pow(least, {e} - 1) / {z} <= {most} * (1 + 1e-12))"

    grid = mixing.GRID
    return f"""WITH RECURSIVE tok AS (SELECT doc_id AS k, source AS s, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS n FROM documents),
src AS (SELECT s, sum(n)::DOUBLE AS t, sum(n) / (SELECT sum(n) FROM tok)::DOUBLE AS share FROM tok GROUP BY s HAVING sum(n) > 0),
par AS (SELECT l, len(l) AS n, l[1] AS least, -list_sum(list_transform(l, lambda x: x * ln(x))) AS nat FROM (SELECT list(share ORDER BY share) AS l FROM src)),
tar AS (SELECT *, nat + {gain} * (ln(n) - nat) AS target FROM par),
it(i, lo, hi) AS (SELECT 0, 0.0::DOUBLE, 1.0::DOUBLE UNION ALL
  SELECT i + 1, CASE WHEN j = 1 THEN lo ELSE g[j - 1] END, CASE WHEN j = {grid} THEN hi ELSE g[j] END FROM (
    SELECT i, lo, hi, g, coalesce(list_position(list_transform(g, lambda e: {met("e")}), true), {grid}) AS j
    FROM (SELECT i, lo, hi, l, least, target, list_transform(range(1, {grid}), lambda q: lo + (hi - lo) * q / {grid}) AS g FROM it, tar WHERE i < {mixing.PASSES}))),
ex AS (SELECT CASE WHEN n <= 1 THEN 1.0 WHEN {met("0.0::DOUBLE")} THEN 0.0 ELSE hi END AS e, l FROM it, tar WHERE i = {mixing.PASSES}),
plan AS (SELECT s, t, w, w * b AS quota, floor(w * b / t + 1e-9)::BIGINT AS full_, least(ceil(t / {mixing.BLOCK_TOKENS}), {mixing.MAX_BLOCKS})::BIGINT AS nb
  FROM (SELECT s, t, pow(share, e) / {sums("e")[0]} AS w, (SELECT sum(t) FROM src) AS b FROM src, ex)),
d AS (SELECT k, n, plan.*, {order(0, "k::VARCHAR")} % nb AS block, {order(1, "k::VARCHAR", "full_::VARCHAR")} AS cut FROM tok JOIN plan ON tok.s IS NOT DISTINCT FROM plan.s),
bl AS (SELECT s, block, t, quota, full_, sum(n) AS bt FROM d GROUP BY ALL),
vi AS (SELECT *, quota - done AS left_ FROM (SELECT *, epoch * t + coalesce(sum(bt) OVER (PARTITION BY s, epoch ORDER BY {order(2, "s", "block::VARCHAR", "epoch::VARCHAR")}, block ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS done
  FROM (SELECT *, unnest(range(full_ + 1)) AS epoch FROM bl)) WHERE done < quota),
cu AS (SELECT s, block, epoch, max(cut) AS upto FROM (SELECT vi.s, vi.block, epoch, left_, cut, sum(d.n) OVER (PARTITION BY vi.s, vi.block ORDER BY cut) AS had FROM vi JOIN d ON vi.s IS NOT DISTINCT FROM d.s AND vi.block = d.block WHERE left_ < bt) WHERE had <= left_ GROUP BY ALL)
SELECT k AS doc_id, d.s AS source, vi.epoch::INT AS epoch, n AS n_tokens, d.block AS block, round(done / vi.quota, 9) AS position, round(w, 9) AS weight
FROM d JOIN vi ON d.s IS NOT DISTINCT FROM vi.s AND d.block = vi.block LEFT JOIN cu ON cu.s IS NOT DISTINCT FROM vi.s AND cu.block = vi.block AND cu.epoch = vi.epoch
WHERE n > 0 AND (left_ >= bt OR cut <= upto)"""


def _quality_sql() -> str:
    q = quality_rules
    tests = ", ".join(f"('{r}', {i}, {float(c)}::DOUBLE)" for r, cuts in q.RULES.items() for i, c in enumerate(cuts))
    values = {
        "symbol_ratio": "n_symbols / greatest(n_words, 1)", "dup_line_ratio": "n_dup_lines / greatest(n_lines, 1)", "repeat_ratio": "n_repeat_words / greatest(n_words, 1)",
        "upper_ratio": "n_upper / greatest(word_chars, 1)", "mean_word": "word_chars / greatest(n_words, 1)",
    }
    value = "CASE r " + " ".join(f"WHEN '{r}' THEN {v}" for r, v in values.items()) + " END"
    tail = "ln(list_sum(list_transform(range(k + 1), lambda j: exp(lgamma(n + 1) - lgamma(j + 1) - lgamma(n - j + 1) + j * ln(p) + (n - j) * ln(1 - p)))))"
    only = lambda wanted: f"length(regexp_replace(t, '[^{wanted}]+', '', 'g'))"
    return f"""WITH d AS (SELECT doc_id, lang, coalesce(text, '') AS t FROM documents),
l AS (SELECT *, regexp_extract_all(t, '[^\\x20\\x09-\\x0D]+') AS w, list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS ls FROM d),
win AS (SELECT doc_id, p, count(*) OVER (PARTITION BY doc_id, w[p], w[p + 1], w[p + 2]) AS c FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS p FROM l)),
rep AS (SELECT doc_id, count(*) AS n_repeat_words FROM (SELECT DISTINCT doc_id, p + o AS at FROM win, range(3) r(o) WHERE c > 1) GROUP BY doc_id),
m AS (SELECT doc_id, lang, t, len(w)::BIGINT AS n_words, coalesce(list_sum(list_transform(w, lambda x: length(x))), 0)::BIGINT AS word_chars, {only(q.SYMBOLS)} AS n_symbols, len(ls) AS n_lines,
  (len(ls) - len(list_distinct(ls)))::BIGINT AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words, {only("A-Z")} AS n_upper FROM l LEFT JOIN rep USING (doc_id)),
b AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM m),
te AS (SELECT * FROM (VALUES {tests}) v(r, i, c)),
held AS (SELECT lang, t, max(q) AS q, any_value(n_words) AS n_words, any_value(word_chars) AS word_chars, any_value(n_symbols) AS n_symbols, any_value(n_lines) AS n_lines, any_value(n_dup_lines) AS n_dup_lines,
  any_value(n_repeat_words) AS n_repeat_words, any_value(n_upper) AS n_upper FROM b JOIN (SELECT doc_id, max(quality) AS q FROM labels WHERE quality IN (0, 1) GROUP BY doc_id) USING (doc_id) WHERE NOT base_failed GROUP BY lang, t),
cnt AS (SELECT lang, r, i, any_value(c) AS c, count(*) FILTER (q = 1) AS n, count(*) FILTER (q = 1 AND {value} > c) AS k, count(*) FILTER (q = 0 AND {value} > c) AS bad FROM held, te GROUP BY lang, r, i),
st AS (SELECT lang, any_value(n) AS n, count(DISTINCT r) FILTER (bad > 0) AS mm, {q.ALPHA}::DOUBLE / greatest(count(DISTINCT r) FILTER (bad > 0), 1) AS p FROM cnt GROUP BY lang),
lev AS (SELECT ln({q.DELTA}::DOUBLE / coalesce(sum(mm), 1)) AS level FROM st WHERE n > 0 AND mm > 0 AND n * ln(1 - p) <= ln({q.DELTA}::DOUBLE / mm)),
ok AS (SELECT lang, r, i, c, bad, bool_and(CASE WHEN k >= n OR k > n * p THEN 0.0 <= level ELSE {tail} <= level END) OVER (PARTITION BY lang, r ORDER BY i) AS alive
  FROM (SELECT cnt.*, st.p, level FROM cnt JOIN st ON cnt.lang IS NOT DISTINCT FROM st.lang, lev WHERE st.n > 0)),
cut AS (SELECT lang, r, c FROM (SELECT *, row_number() OVER (PARTITION BY lang, r ORDER BY bad DESC, i) AS rk FROM ok WHERE alive AND bad > 0) WHERE rk = 1),
fails AS (SELECT DISTINCT b.doc_id FROM b JOIN cut ON b.lang IS NOT DISTINCT FROM cut.lang WHERE {value} > c)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND doc_id NOT IN (SELECT doc_id FROM fails) AS kept FROM b"""


def _quotes_sql() -> str:
    c = chat_quotes
    marks, punctuation = (_quoted(x).replace("\t", "' || chr(9) || '") for x in (c.MARKS, c.PUNCTUATION))
    norm = lambda x: f"trim(regexp_replace(lower({x}), '[\\x09-\\x0D\\x20]+', ' ', 'g'), {punctuation})"
    paragraphs, nl = r"'\n[\x09-\x0D\x20]*\n'", "chr(10)"

    def parts(source: str, keys: str, text: str) -> str:
        """keys, f, l, h of the lines of a text and of its paragraphs."""
        return f"""(SELECT DISTINCT * FROM (WITH pa AS (SELECT {keys}, unnest(ps) AS p, unnest(range(len(ps))) AS k FROM (SELECT *, string_split_regex({text}, {paragraphs}) AS ps FROM {source})),
  li AS (SELECT {keys}, p, k, list_filter(list_transform(string_split(p, {nl}), lambda x: {norm("x")}), lambda x: x <> '') AS ls FROM pa),
  nu AS (SELECT *, coalesce(sum(len(ls)) OVER (PARTITION BY {keys} ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS a FROM li)
  SELECT {keys}, a AS f, a + len(ls) - 1 AS l, {norm("p")} AS h FROM nu WHERE len(ls) > 0 UNION ALL SELECT {keys}, a + i, a + i, h FROM (SELECT {keys}, a, unnest(ls) AS h, unnest(range(len(ls))) AS i FROM nu)))"""

    chain = """list_max(list_transform(list_reduce(list_transform(list_sort(list({'f': f, 'l': l, 'hf': hf, 'hl': hl})), lambda x: [{'l': x.l, 'hl': x.hl, 'f': x.f, 'hf': x.hf, 'n': x.l - x.f + 1}]),
  lambda acc, x: list_concat(acc, [{'l': x[1].l, 'hl': x[1].hl, 'f': x[1].f, 'hf': x[1].hf, 'n': x[1].n + coalesce(list_max(list_transform(list_filter(acc, lambda y: y.l < x[1].f AND y.hl < x[1].hf), lambda y: y.n)), 0)}])), lambda y: y.n))"""
    return f"""WITH RECURSIVE m AS (SELECT row_number() OVER () AS rid, conv_id AS c, turn AS t, role, string_split_regex(coalesce(text, ''), '\\r?\\n') AS ls FROM conversations),
ln AS (SELECT rid, c, t, unnest(ls) AS x, unnest(range(len(ls))) AS i FROM m),
lv AS (SELECT *, length(mk) - length(replace(mk, '>', '')) AS n, ltrim(x, {marks}) AS rest FROM (SELECT *, x[1:length(x) - length(ltrim(x, {marks}))] AS mk FROM ln)),
top AS (SELECT rid, max(n) AS n FROM lv GROUP BY rid),
own AS (SELECT rid, string_agg(x, {nl} ORDER BY i) AS b FROM lv JOIN top USING (rid) WHERE lv.n = 0 AND NOT (top.n > 0 AND regexp_matches(x, {_quoted(c.ATTRIBUTION.replace("(?i)", ""))}, 'i')) GROUP BY rid),
msg AS (SELECT m.rid, c, t, role, trim(coalesce(b, ''), ' ' || chr(9) || chr(13) || {nl}) AS body, top.n AS quote_levels FROM m JOIN top USING (rid) LEFT JOIN own USING (rid)),
runs AS (SELECT rid, c, t, n, run, string_agg(rest, {nl} ORDER BY i) AS q FROM (SELECT *, sum(new) OVER (PARTITION BY rid ORDER BY i) AS run FROM
  (SELECT *, (n <> coalesce(lag(n) OVER (PARTITION BY rid ORDER BY i), -1))::INT AS new FROM lv)) WHERE n > 0 GROUP BY ALL),
pas AS (SELECT rid, c, t, n, q, row_number() OVER (PARTITION BY rid ORDER BY run) - 1 AS pos, {norm("q")} AS h FROM runs WHERE {norm("q")} <> ''),
qs AS (SELECT DISTINCT c, t, pos, n, q, h FROM pas WHERE c IS NOT NULL AND t IS NOT NULL),
ho AS (SELECT c, h, min(t) AS u FROM (SELECT c, t, unnest(list_transform(list_concat([body], string_split_regex(body, {paragraphs}), string_split(body, {nl})), lambda x: {norm("x")})) AS h FROM msg WHERE t IS NOT NULL AND c IN (SELECT c FROM qs)) WHERE h <> '' GROUP BY c, h),
wh AS (SELECT qs.*, u FROM qs JOIN ho ON qs.c = ho.c AND qs.h = ho.h AND u < t),
re AS (SELECT * FROM qs ANTI JOIN wh USING (c, t, pos, n, h)),
bo AS (SELECT c, body, min(t) AS u FROM msg WHERE t IS NOT NULL AND c IN (SELECT c FROM re) GROUP BY c, body),
sc AS (SELECT c, t, pos, n, u, {chain} AS w FROM (SELECT a.c, a.t, a.pos, a.n, a.q, b.u, b.body, a.f, a.l, b.f AS hf, b.l AS hl
  FROM {parts("re", "c, t, pos, n, q", "q")} a JOIN {parts("bo", "c, u, body", "body")} b ON a.c = b.c AND a.h = b.h AND b.u < a.t) GROUP BY c, t, pos, n, q, u, body),
lk AS (SELECT c, t, arg_min(u, (n, pos)) AS up, count(DISTINCT pos) AS n_linked FROM (SELECT c, t, pos, n, u FROM wh UNION ALL SELECT c, t, pos, n, arg_min(u, (-w, u)) FROM sc GROUP BY c, t, pos, n) GROUP BY c, t),
tr(c, t, root, path) AS (SELECT DISTINCT c, up, up, [up] FROM lk WHERE (c, up) NOT IN (SELECT (c, t) FROM lk) UNION ALL SELECT tr.c, lk.t, tr.root, list_append(path, lk.t) FROM tr JOIN lk ON lk.c = tr.c AND lk.up = tr.t),
pl AS (SELECT c, t, root, row_number() OVER (PARTITION BY c, root ORDER BY path) - 1 AS place FROM tr)
SELECT msg.c AS conv_id, msg.t AS turn, role, body, quote_levels, coalesce(nq, 0) AS n_quotes, coalesce(n_linked, 0) AS n_linked, up AS reply_to, coalesce(root, msg.t) AS thread,
  CASE WHEN msg.t IS NOT NULL THEN coalesce(place, 0) END AS place
FROM msg LEFT JOIN (SELECT rid, count(*) AS nq FROM pas GROUP BY rid) USING (rid) LEFT JOIN lk ON lk.c = msg.c AND lk.t = msg.t LEFT JOIN pl ON pl.c = msg.c AND pl.t = msg.t"""


AUDIT_SQL = """WITH d AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t FROM documents),
f AS (SELECT *, regexp_extract_all(t, '[^\\x20\\x09-\\x0D]+') AS w, min(doc_id) OVER (PARTITION BY t) AS first FROM d),
m AS (SELECT doc_id, part, [len(w) < 200, 100 * len(list_distinct(w)) < 50 * len(w), 100 * length(regexp_replace(t, '[^A-Z]+', '', 'g')) > 2 * length(t), regexp_matches(t, '[#$%&*|]'), coalesce(doc_id > first, false)] AS x FROM f),
l AS (SELECT doc_id, coalesce(bool_or(quality = 1), false) AS good, coalesce(bool_or(toxic = 1), false) AS toxic FROM labels GROUP BY doc_id),
c AS (SELECT part, x, count(*) AS n, count(*) FILTER (good) AS good, count(*) FILTER (toxic) AS toxic FROM m LEFT JOIN l USING (doc_id) GROUP BY part, x),
n AS (SELECT unnest(range(1, 6)) AS i),
o AS (SELECT [a.i, b.i, c.i, d.i, e.i] AS o FROM n a, n b, n c, n d, n e WHERE len(list_distinct([a.i, b.i, c.i, d.i, e.i])) = 5),
s AS (SELECT c.*, o, k, o[k] AS f, x[o[k]] AS fails, list_bool_or(list_transform(o[1:k - 1], lambda j: x[j])) IS NOT DISTINCT FROM true AS gone, len(list_filter(x, lambda y: y)) AS failed
  FROM c, o, (SELECT i AS k FROM n)),
g AS (SELECT part, o, k, f, coalesce(sum(n) FILTER (NOT fails AND NOT gone), 0) AS kept, coalesce(sum(n) FILTER (fails AND NOT gone), 0) AS removed, coalesce(sum(n) FILTER (fails AND gone), 0) AS redundant,
  coalesce(sum(n) FILTER (fails AND failed = 1), 0) AS unique_fails, coalesce(sum(good) FILTER (fails AND NOT gone), 0) AS good_lost, coalesce(sum(toxic) FILTER (fails AND NOT gone), 0) AS toxic_lost FROM s GROUP BY part, o, k, f)
SELECT part, array_to_string(list_transform(o, lambda i: 'ABCDE'[i]), '') AS filter_order, k::INT AS step, kept::BIGINT AS kept, removed::BIGINT AS removed, redundant::BIGINT AS redundant, unique_fails::BIGINT AS unique_fails,
  good_lost::BIGINT AS good_lost, toxic_lost::BIGINT AS toxic_lost, (sum(removed) OVER (PARTITION BY part, f))::BIGINT AS shapley FROM g"""

MIDDLE_SQL = """WITH d AS (SELECT doc_id, coalesce(text, '') AS t, sha256('42:' || doc_id) AS h FROM documents),
u AS (SELECT *, regexp_extract_all(t, '[\\x20\\x09-\\x0D]*[^\\x20\\x09-\\x0D]+|[\\x20\\x09-\\x0D]+') AS k, list_transform(range(4), lambda i: ('0x' || h[8 * i + 1:8 * i + 8])::UBIGINT::BIGINT) AS h4 FROM d),
c AS (SELECT *, len(k) AS n, least(h4[1] % (len(k) + 1), h4[2] % (len(k) + 1)) AS lo, greatest(h4[1] % (len(k) + 1), h4[2] % (len(k) + 1)) AS hi,
  CASE WHEN t = '' OR regexp_matches(t, '<P>|<S>|<M>') OR h4[3] % 100 >= 50 THEN 'plain' WHEN h4[4] % 100 < 80 THEN 'spm' ELSE 'psm' END AS form FROM u),
p AS (SELECT *, array_to_string(k[1:lo], '') AS p, array_to_string(k[lo + 1:hi], '') AS m, array_to_string(k[hi + 1:], '') AS s FROM c)
SELECT doc_id, n::BIGINT AS n, form, CASE WHEN form <> 'plain' THEN length(p) END::BIGINT AS prefix_chars, CASE WHEN form <> 'plain' THEN length(m) END::BIGINT AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256, sha256(p || m || s) AS restored_sha256 FROM p"""


ORACLE = {"op11_filter_audit": AUDIT_SQL, "op13_fill_in_middle": MIDDLE_SQL, "op6_quotation_links": _quotes_sql(), "op7_quality_rules": _quality_sql(), "op2_mixing": _mixing_sql(), "op9_ngram_join": JACCARD_SQL, "op1_secret_scan": _secret_sql(), "op10_warc_index": WARC_SQL}
