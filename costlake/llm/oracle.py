"""DuckDB SQL for the queries of the subpackage that SQL can express."""

from __future__ import annotations

from costlake.llm.licenses import COMMENT_BREAK, LICENSE_FILE, MIN_COSINE, NAMES_LICENCE, TEMPLATES
from costlake.llm.ngram_lm import BACKOFF
from costlake.llm.quality_rules import MAX_HOST_RATE, MAX_REPEAT_PCT, MIN_WORDS, REPEAT_WINDOW

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_PLAIN = rf"regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

OP1 = rf"""
WITH d AS (SELECT doc_id, {_PLAIN} AS words FROM documents),
it AS (SELECT item_id, {_PLAIN} AS words FROM benchmark),
sized AS (SELECT item_id, words, least(13, len(words)) AS n FROM it WHERE len(words) > 0),
win AS (SELECT DISTINCT item_id, n, array_to_string(words[i:i + n - 1], ' ') AS w
        FROM sized, unnest(range(1, len(words) - n + 2)) AS u(i)),
lens AS (SELECT DISTINCT n FROM win),
grams AS (SELECT doc_id, n, i, array_to_string(words[i:i + n - 1], ' ') AS w
          FROM d, lens, unnest(range(1, len(words) - n + 2)) AS u(i)),
hits AS (SELECT doc_id, item_id, i, n FROM grams JOIN win USING (n, w)),
covered AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM hits, unnest(range(i, i + n)) AS u(p) GROUP BY doc_id),
named AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids
          FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hits) GROUP BY doc_id),
-- Near matches: a word of the item stands within two words of its place on a diagonal (start in the
-- document less place in the item); a window is near where at most a fifth of its words do not.
tok AS (SELECT doc_id, p, words[p] AS w FROM d, unnest(range(1, len(words) + 1)) AS u(p)),
itok AS (SELECT item_id, n, q, words[q] AS w FROM sized, unnest(range(1, len(words) + 1)) AS u(q)),
placed AS (SELECT DISTINCT doc_id, item_id, n, p - q + s AS diag, q FROM tok JOIN itok USING (w), unnest(range(-2, 3)) AS u(s)),
dense AS (SELECT doc_id, item_id, diag FROM placed GROUP BY doc_id, item_id, n, diag HAVING count(*) >= ceil(0.8 * n)),
near AS (SELECT doc_id, item_id, n, diag, i FROM placed JOIN dense USING (doc_id, item_id, diag) JOIN sized USING (item_id, n),
              unnest(range(greatest(1, q - n + 1), least(q, len(words) - n + 1) + 1)) AS u(i)
         GROUP BY doc_id, item_id, n, diag, i HAVING count(*) >= ceil(0.8 * n)),
near_at AS (SELECT DISTINCT doc_id, n, diag + i AS at_word, array_to_string(words[i:i + n - 1], ' ') AS w
            FROM near JOIN sized USING (item_id, n)),
apart AS (SELECT doc_id, count(DISTINCT w) AS n_near FROM near_at a
          WHERE NOT EXISTS (SELECT 1 FROM grams g WHERE g.doc_id = a.doc_id AND g.n = a.n AND g.w = a.w AND abs(g.i - a.at_word) <= 2)
          GROUP BY doc_id)
SELECT d.doc_id, len(words)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit,
       coalesce(n_items, 0)::BIGINT AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(words) AS contaminated,
       coalesce(n_near, 0)::BIGINT AS n_near
FROM d LEFT JOIN covered USING (doc_id) LEFT JOIN named USING (doc_id) LEFT JOIN apart USING (doc_id)
"""

OP7 = rf"""
WITH d AS (SELECT doc_id, source, coalesce(text, '') AS t,
                  regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents),
lines AS (SELECT doc_id, count(*) - count(DISTINCT line) AS n_dup_lines, count(*) AS n_lines
          FROM (SELECT doc_id, unnest(string_split(t, chr(10))) AS line FROM d)
          WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY doc_id),
windows AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, array_to_string(words[i:i + {REPEAT_WINDOW - 1}], chr(10))) AS times
            FROM d, unnest(range(1, len(words) - {REPEAT_WINDOW - 2})) AS u(i)),
repeated AS (SELECT doc_id, count(DISTINCT p) AS n_repeat_words
             FROM windows, unnest(range(i, i + {REPEAT_WINDOW})) AS u(p) WHERE times > 1 GROUP BY doc_id),
m AS (SELECT doc_id, source, len(words)::BIGINT AS n_words,
             coalesce(list_sum(list_transform(words, lambda w: length(w))), 0)::BIGINT AS word_chars,
             len(regexp_extract_all(t, '[#*$%&|<>]'))::BIGINT AS n_symbols,
             coalesce(n_lines, 0) AS n_lines,
             coalesce(n_dup_lines, 0)::BIGINT AS n_dup_lines, coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words
      FROM d LEFT JOIN lines USING (doc_id) LEFT JOIN repeated USING (doc_id)),
b AS (SELECT *, n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEAT_PCT} * n_words AS base_failed FROM m),
hosts AS (SELECT source, count(*)::DOUBLE AS n,
                 sum((base_failed OR n_symbols * 10 > word_chars OR n_dup_lines * 3 > n_lines)::INT)::DOUBLE AS f
          FROM b GROUP BY source),
pooled AS (SELECT sum(f) / sum(n) AS m, sum(f * f / n) / sum(n) AS msq, count(*) / sum(n) AS noise FROM hosts),
prior AS (SELECT m, 1 / least(0.5, greatest(1e-4, CASE WHEN m > 0 AND m < 1 AND noise < 1
                 THEN ((msq - m * m) / (m * (1 - m)) - noise) / (1 - noise) ELSE 1e-4 END)) - 1 AS k FROM pooled),
verdict AS (SELECT source, (f + m * k) / (n + k) > {MAX_HOST_RATE} AS rejected FROM hosts, prior)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND NOT rejected AS kept
FROM b JOIN verdict ON b.source IS NOT DISTINCT FROM verdict.source
"""

OP6 = """
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS b FROM pages),
d AS (SELECT page_id, octet_length(b)::BIGINT AS payload_bytes, sha1(b) AS payload_digest FROM p),
t AS (SELECT *, max(page_id) OVER (PARTITION BY payload_digest, payload_bytes) AS top FROM d)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 1000 AND page_id <> top THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 1000 AND page_id <> top THEN top END AS refers_to
FROM t
"""

OP3 = rf"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents),
w AS (SELECT doc_id, i, words[i] AS w, CASE WHEN i > 1 THEN words[i - 1] END AS v
      FROM d, unnest(range(1, len(words) + 1)) AS u(i)),
one AS (SELECT w, count(*)::DOUBLE AS c FROM w GROUP BY w),
two AS (SELECT v, w, count(*)::DOUBLE AS c FROM w WHERE v IS NOT NULL GROUP BY v, w),
total AS (SELECT sum(c) AS n FROM one),
own_one AS (SELECT doc_id, w, count(*)::DOUBLE AS c FROM w GROUP BY doc_id, w),
own_two AS (SELECT doc_id, v, w, count(*)::DOUBLE AS c FROM w WHERE v IS NOT NULL GROUP BY doc_id, v, w),
other AS (SELECT w.doc_id, w.v, coalesce(two.c - t.c, 0) AS pair, before.c - b.c AS first, one.c - o.c AS alone,
                 greatest(total.n - len(d.words), 1) AS rest
          FROM w JOIN d USING (doc_id) JOIN total ON true JOIN one USING (w) JOIN own_one o ON o.doc_id = w.doc_id AND o.w = w.w
          LEFT JOIN two ON two.v = w.v AND two.w = w.w LEFT JOIN own_two t ON t.doc_id = w.doc_id AND t.v = w.v AND t.w = w.w
          LEFT JOIN one AS before ON before.w = w.v LEFT JOIN own_one b ON b.doc_id = w.doc_id AND b.w = w.v),
scored AS (SELECT doc_id, v IS NOT NULL AND pair = 0 AS back,
                  CASE WHEN pair > 0 THEN pair / first
                       ELSE CASE WHEN v IS NULL THEN 1 ELSE {BACKOFF} END * greatest(alone, 1) / rest END AS p FROM other)
SELECT d.doc_id, len(words)::BIGINT AS n_words, coalesce(count(*) FILTER (back), 0)::BIGINT AS n_backoff,
       round(coalesce(sum(log10(p)), 0.0), 4) AS lm_score
FROM d LEFT JOIN scored USING (doc_id) GROUP BY d.doc_id, len(words)
"""

_NOTICES = ", ".join("({}, '{}', '{}')".format(i, n, t.replace("'", "''")) for i, (n, t) in enumerate(TEMPLATES))


def _norm(text: str) -> str:
    return (f"array_to_string(regexp_extract_all(translate({text}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', "
            rf"'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), ' ')")


OP4 = rf"""
WITH f AS (SELECT doc_id, coalesce(text, '') AS t,
                  source || '/' || (doc_id // 10000) || '/' || (doc_id // 100) AS dir,
                  regexp_matches(text, '{NAMES_LICENCE}') AS named FROM documents),
p AS (SELECT doc_id, t, dir, CASE WHEN named THEN 'LICENSE' ELSE doc_id || '.txt' END AS name FROM f),
raw AS (SELECT doc_id, unnest(string_split(regexp_replace(t, '{COMMENT_BREAK}', ' ', 'g'), chr(10))) AS x FROM p),
found AS (SELECT DISTINCT doc_id, {_norm('x')} AS line FROM raw WHERE regexp_matches(x, '{NAMES_LICENCE}')),
lines AS (SELECT line, count(*) AS n FROM found GROUP BY line),
total AS (SELECT coalesce(sum(n), 0) AS n FROM lines),
terms AS (SELECT line, n, term, count(*) AS tf
          FROM (SELECT line, n, unnest(string_split(line, ' ')) AS term FROM lines) GROUP BY ALL),
df AS (SELECT term, sum(n) AS df FROM terms GROUP BY term),
idf AS (SELECT term, ln((1.0 + total.n) / (1 + df)) + 1 AS idf FROM df, total),
vec AS (SELECT line, term, tf * idf AS w FROM terms JOIN idf USING (term)),
given AS (SELECT t, license, {_norm('x')} AS line FROM (VALUES {_NOTICES}) AS v(t, license, x)),
tterms AS (SELECT t, license, term, count(*) AS tf
           FROM (SELECT t, license, unnest(string_split(line, ' ')) AS term FROM given) GROUP BY ALL),
tvec AS (SELECT t, license, term, tf * coalesce(idf, ln(1.0 + total.n) + 1) AS w
         FROM tterms LEFT JOIN idf USING (term), total),
cosine AS (SELECT v.line, t.license, sum(v.w * t.w) / (any_value(a.n) * any_value(b.n)) AS c
           FROM vec v JOIN tvec t USING (term)
           JOIN (SELECT line, sqrt(sum(w * w)) AS n FROM vec GROUP BY line) a ON a.line = v.line
           JOIN (SELECT t, sqrt(sum(w * w)) AS n FROM tvec GROUP BY t) b ON b.t = t.t
           GROUP BY v.line, t.t, t.license),
ranked AS (SELECT line, license, round(c, 6) AS similarity,
                  row_number() OVER (PARTITION BY line ORDER BY round(c, 6) DESC, license) AS r FROM cosine),
own AS (SELECT doc_id, license, similarity,
               row_number() OVER (PARTITION BY doc_id ORDER BY similarity DESC, license) AS r
        FROM found JOIN ranked USING (line) WHERE ranked.r = 1 AND similarity >= {MIN_COSINE}),
owned AS (SELECT p.*, license, similarity FROM p LEFT JOIN (FROM own WHERE r = 1) USING (doc_id)),
given_dir AS (SELECT dir AS up, license, similarity,
                     row_number() OVER (PARTITION BY dir ORDER BY similarity DESC, license) AS r
              FROM owned WHERE license IS NOT NULL AND regexp_matches(name, '{LICENSE_FILE}')),
above AS (SELECT dir, k, array_to_string(string_split(dir, '/')[:k], '/') AS up
          FROM (SELECT DISTINCT dir FROM p), unnest(range(0, len(string_split(dir, '/')) + 1)) AS u(k)),
nearest AS (SELECT dir, up, license, similarity, row_number() OVER (PARTITION BY dir ORDER BY k DESC) AS r
            FROM above JOIN (FROM given_dir WHERE r = 1) USING (up))
SELECT o.doc_id, o.dir || '/' || o.name AS path, coalesce(o.license, n.license) AS license,
       coalesce(o.similarity, n.similarity) AS similarity,
       CASE WHEN o.license IS NOT NULL THEN 'file' WHEN n.license IS NOT NULL THEN 'inherited' END AS license_from,
       CASE WHEN o.license IS NULL THEN n.up END AS license_dir
FROM owned o LEFT JOIN (SELECT dir, up, license, similarity FROM nearest WHERE r = 1) n USING (dir)
"""



def _merkle_sql(levels: int = 8) -> str:
    """The tree and its proofs, one step a level, over trees of up to 16^levels
    leaves; with crc32 of the decimal id spelt out bit by bit."""

    def enc(c: str) -> str:
        return f"coalesce(strlen(CAST({c} AS VARCHAR)) || ':' || CAST({c} AS VARCHAR), '-')"

    def leaf(text: str) -> str:
        return "sha256(" + " || ".join(enc(c) for c in ("doc_id", "source", "lang", "n_chars", text)) + ")"

    def tree(name: str, base: str, key: str) -> list[str]:
        """Levels ``name0..`` (key, pos, node, n) over ``base``, the joined arrays
        between them, and per node of level 0 its steps as two lists."""
        out = [f"{name}0 AS ({base})"]
        for k in range(levels):
            out.append(f"{name}{k + 1} AS (SELECT {key}, pos // 16 AS pos, sha256(string_agg(node, '' ORDER BY pos)) AS node, "
                       f"(any_value(n) + 15) // 16 AS n FROM {name}{k} WHERE n > 1 GROUP BY {key}, pos // 16)")
            out.append(f"{name}w{k} AS (SELECT a.{key}, a.pos, coalesce(string_agg(b.node, '' ORDER BY b.pos) FILTER (b.pos < a.pos), '') AS pre, "
                       f"coalesce(string_agg(b.node, '' ORDER BY b.pos) FILTER (b.pos > a.pos), '') AS post "
                       f"FROM {name}{k} a JOIN {name}{k} b ON a.{key} = b.{key} AND a.pos // 16 = b.pos // 16 WHERE a.n > 1 GROUP BY a.{key}, a.pos)")
        tops = " UNION ALL ".join(f"SELECT {key}, node FROM {name}{k} WHERE n = 1" for k in range(levels + 1))
        out.append(f"{name}top AS ({tops})")
        steps = " ".join(f"LEFT JOIN {name}w{k} s{k} ON s{k}.{key} = x.{key} AND s{k}.pos = x.pos // {16 ** k}" for k in range(levels))
        pre, post = (", ".join(f"s{k}.{c}" for k in range(levels)) for c in ("pre", "post"))
        out.append(f"{name}path AS (SELECT x.{key}, x.pos, list_filter([{pre}], lambda s: s IS NOT NULL) AS pre, "
                   f"list_filter([{post}], lambda s: s IS NOT NULL) AS post FROM {name}0 x {steps})")
        return out

    bit = "xor(c >> 1, CASE WHEN c & 1 = 1 THEN 3988292384 ELSE 0 END)"
    step = "xor(c, b)"
    for _ in range(8):
        step = f"list_transform([{step}], lambda c: {bit})[1]"
    crc = (f"xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(CAST(doc_id AS VARCHAR), ''), "
           f"lambda s: ascii(s)::BIGINT)), lambda c, b: {step}), 4294967295)")
    low = f"CASE WHEN text IS NULL THEN NULL ELSE translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') END"
    parts = [f"d AS (SELECT doc_id, coalesce('s' || source, '') AS grp, {leaf('text')} AS leaf, {leaf('low')} AS forged, "
             f"coalesce({crc} % 5 = 0, false) AS bad FROM (SELECT *, {low} AS low FROM documents))",
             "l AS (SELECT *, row_number() OVER (PARTITION BY grp ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos, "
             "count(*) OVER (PARTITION BY grp) AS n FROM d)"]
    parts += tree("t", "SELECT grp, pos, leaf AS node, n FROM l", "grp")
    parts += tree("r", "SELECT 1 AS one, row_number() OVER (ORDER BY encode(grp)) - 1 AS pos, node, count(*) OVER () AS n, grp FROM ttop", "one")
    parts.append("full_path AS (SELECT l.*, s.node AS subroot, rtop.node AS root, list_concat(p.pre, q.pre) AS pre, "
                 "list_concat(p.post, q.post) AS post FROM l JOIN tpath p ON p.grp = l.grp AND p.pos = l.pos "
                 "JOIN r0 s ON s.grp = l.grp JOIN rpath q ON q.pos = s.pos CROSS JOIN rtop)")
    parts.append("folded AS (SELECT *, CASE WHEN bad THEN forged ELSE leaf END AS start FROM full_path)")
    climb = "start"
    for k in range(1, 2 * levels + 1):
        climb = f"CASE WHEN len(pre) < {k} THEN f{k - 1} ELSE sha256(pre[{k}] || f{k - 1} || post[{k}]) END"
        parts.append(f"fold{k} AS (SELECT *, {climb} AS f{k} FROM {'folded0' if k == 1 else f'fold{k - 1}'})")
        if k == 1:
            parts.insert(-1, "folded0 AS (SELECT *, start AS f0 FROM folded)")
    last = f"f{2 * levels}"
    return "WITH " + ",\n".join(parts) + f"""
SELECT doc_id, leaf, subroot, root,
       sha256(array_to_string(list_transform(range(1, len(pre) + 1), lambda i: pre[i] || post[i]), '')) AS proof_sha256,
       {last} AS folded_root, {last} = root AS verified
FROM fold{2 * levels}
"""


OP12 = _merkle_sql(levels=4)

SQL = {"op12_merkle_manifest": OP12, "op3_stupid_backoff": OP3, "op4_license_scan": OP4, "op6_warc": OP6, "op1_decontaminate": OP1, "op7_host_quality": OP7}
