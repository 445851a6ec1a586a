"""SQL that gives the same rows as the queries which SQL can express.

The statements are for DuckDB and run over the whole tables. They share no code
with the operators but their parameters.
"""

from __future__ import annotations

from collections.abc import Sequence

from tilewright.llm import host_reputation, sentence_spans, sharding


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def host_reputation_sql(rules: Sequence[tuple[str, str]]) -> str:
    """Verdicts on all rows of ``pages`` from the outcomes in ``labels``."""
    listed = ", ".join(f"({_quoted(rule)}, {_quoted(says)})" for rule, says in rules)
    suffixes = ", ".join(map(_quoted, host_reputation.SUFFIXES))

    def strength(level: str) -> str:
        return f"""(
  SELECT CASE WHEN units < 2 OR total <= units OR spread <= 0 OR between_ <= within_ THEN {host_reputation.STRONGEST}
              ELSE least({host_reputation.STRONGEST}, greatest({host_reputation.WEAKEST},
                   (1 - (between_ - within_) / spread) / ((between_ - within_) / spread))) END AS s
  FROM (SELECT *, between_ + ((total - nn / total) / (units - 1) - 1) * within_ AS spread
        FROM (SELECT *, (kk - k * k / total) / (units - 1) AS between_, (k - kk) / (total - units) AS within_
              FROM (SELECT count(*)::DOUBLE AS units, sum(n)::DOUBLE AS total, sum(bad)::DOUBLE AS k,
                           sum(n * n)::DOUBLE AS nn,
                           sum(CAST((bad * bad)::DOUBLE / n AS DECIMAL(28, 9)))::DOUBLE AS kk
                    FROM {level} WHERE n > 0))))"""

    return f"""
WITH cut_urls AS (
  SELECT page_id,
         translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), ''),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path
  FROM pages
), outcomes AS (
  SELECT doc_id, max(CASE WHEN toxic = 1 OR quality = 0 THEN 1 ELSE 0 END) AS bad FROM labels GROUP BY doc_id
), by_host AS (
  SELECT host, CAST(count(bad) AS BIGINT) AS n, CAST(coalesce(sum(bad), 0) AS BIGINT) AS bad
  FROM cut_urls LEFT JOIN outcomes ON page_id = doc_id GROUP BY host
), parts AS (
  SELECT *, string_split(host, '.') AS p, array_to_string(list_slice(string_split(host, '.'), -2, -1), '.') AS two FROM by_host
), hosts AS (
  SELECT host, n, bad,
         CASE WHEN two IN ({suffixes}) THEN two ELSE p[-1] END AS suffix,
         CASE WHEN two IN ({suffixes}) THEN array_to_string(list_slice(p, -3, -1), '.') ELSE two END AS domain
  FROM parts
), domains AS (
  SELECT domain, suffix, sum(n)::BIGINT AS n, sum(bad)::BIGINT AS bad FROM hosts GROUP BY domain, suffix
), suffixes AS (
  SELECT suffix, sum(n)::BIGINT AS n, sum(bad)::BIGINT AS bad FROM domains GROUP BY suffix
), overall AS (
  SELECT CASE WHEN sum(n) > 0 THEN sum(bad)::DOUBLE / sum(n)::DOUBLE ELSE 0.0 END AS rate FROM suffixes
), s_suffix AS {strength("suffixes")}, s_domain AS {strength("domains")}, s_host AS {strength("hosts")},
of_suffix AS (
  SELECT suffix, (rate * s + bad) / (n + s) AS above FROM suffixes, overall, s_suffix
), of_domain AS (
  SELECT domain, (above * s + bad) / (n + s) AS above FROM domains JOIN of_suffix USING (suffix), s_domain
), rates AS (
  SELECT host, (above * s + bad) / (n + s) AS rate, n + s + 1 AS weight FROM hosts JOIN of_domain USING (domain), s_host
), bounds AS (
  SELECT host, round(greatest(0.0, rate - {host_reputation.Z}::DOUBLE * sqrt(rate * (1 - rate) / weight)), 6) AS bad_bound FROM rates
), rules(rule, says) AS (VALUES {listed}
), fitting AS (
  SELECT host, path, rule, says,
         row_number() OVER (PARTITION BY host, path ORDER BY length(rule) DESC, rule DESC) AS place
  FROM (SELECT DISTINCT host, path FROM cut_urls), rules
  WHERE (host = split_part(rule, '/', 1) OR ends_with(host, '.' || split_part(rule, '/', 1)))
    AND starts_with(path, substr(rule, strpos(rule, '/')))
)
SELECT u.page_id, u.host, u.path, f.rule,
       coalesce(f.says, CASE WHEN b.bad_bound >= {host_reputation.BLOCK_FROM} THEN 'block' ELSE 'allow' END) AS verdict,
       b.bad_bound
FROM cut_urls u JOIN bounds b USING (host)
LEFT JOIN fitting f ON f.host = u.host AND f.path = u.path AND f.place = 1
"""


def _crc_step(crc: str, byte: str) -> str:
    """CRC-32 after one byte more: the remainders of its eight bits, as they add up without carry."""
    low, step = f"xor({crc}, {byte})", f"{crc} >> 8"
    for bit in range(8):
        rest = 1 << bit
        for _ in range(8):
            rest = rest >> 1 ^ (0xEDB88320 if rest & 1 else 0)
        step = f"xor({step}, ({low} >> {bit} & 1) * {rest})"
    return step


def feistel_shards_sql(shards: int, seed: int) -> str:
    """Shard and slot of all rows of ``documents`` under the law ``rows``."""
    prime, (first, second) = sharding.PRIME, sharding.MULTIPLIERS
    keys, state = [], f"({seed}::BIGINT % ({prime} - 1) + 1)"
    for i in range(sharding.ROUNDS):
        keys.append(f"{state} * {first} % {prime} AS k{i}")
        state = f"k{i}"

    def network(source: str) -> str:
        """A select of row and ``passed``, the value of ``cell`` in ``source`` after one pass."""
        steps = f"SELECT row, n, a, b, {', '.join(f'k{i}' for i in range(sharding.ROUNDS))}, cell // b AS l, cell % b AS r FROM {source}"
        for i in range(sharding.ROUNDS):
            moved, other, side = ("l", "r", "a") if i % 2 == 0 else ("r", "l", "b")
            steps = f"SELECT *, ({other} % {prime} * {first} + k{i}) % {prime} AS f{i} FROM ({steps})"
            steps = f"SELECT *, (f{i} * f{i} + k{i}) % {prime} AS q{i} FROM ({steps})"
            turned = f"({moved} + (xor(q{i}, q{i} >> 13) * {second} + k{i}) % {prime}) % {side}"
            steps = f"SELECT * REPLACE ({turned} AS {moved}) FROM ({steps})"
        return f"SELECT row, l * b + r AS passed FROM ({steps})"

    digit = "strpos('0123456789ABCDEF', {}) - 1".format
    return f"""
WITH RECURSIVE bytes AS (
  SELECT doc_id, CAST(octet_length(encode(coalesce(text, ''))) + 8 AS BIGINT) AS size,
         list_transform(regexp_extract_all(hex(encode(coalesce(text, ''))), '..'),
                        lambda x: CAST(({digit("x[1]")}) * 16 + {digit("x[2]")} AS BIGINT)) AS v
  FROM documents
), numbered AS (
  SELECT doc_id, size, text_crc32, row_number() OVER (ORDER BY doc_id NULLS FIRST, text_crc32, size) - 1 AS row
  FROM (SELECT doc_id, size,
               xor(list_reduce(v, lambda acc, v: {_crc_step("acc", "v")}, 4294967295::BIGINT), 4294967295::BIGINT) AS text_crc32
        FROM bytes)
), rows AS (
  SELECT greatest(1, count(*))::BIGINT AS n, greatest(1, floor(sqrt(greatest(0, count(*) - 1))) + 1)::BIGINT AS a FROM documents
), grid AS (
  SELECT n, a, greatest(1, (n + a - 1) // a) AS b, {", ".join(keys)} FROM rows
), walk AS (
  {network("(SELECT *, row AS cell FROM numbered, grid)")}
  UNION ALL
  {network("(SELECT row, passed AS cell, grid.* FROM walk, grid WHERE passed >= n)")}
)
SELECT doc_id, size, text_crc32, 'rows' AS law, CAST(passed % {shards} AS INTEGER) AS shard,
       CAST(passed // {shards} AS BIGINT) AS slot, CAST(NULL AS INTEGER) AS grown_shard
FROM numbered JOIN walk USING (row), grid
WHERE passed < n
"""


def sentence_spans_sql(min_words: int = sentence_spans.MIN_WORDS, long_words: int = sentence_spans.LONG_WORDS) -> str:
    """All texts of ``documents`` without repeated runs of sentences; runs are compared by their sentences, not by hashes.

    Runs take at most ``min_words`` sentences, as each has a word. Ids are taken as unique but for repeated rows.
    """
    white = r"[\s\x0b\x1c-\x1f\x{85}\p{Z}]"
    end = rf"(?:[.!?。！？]+[\"'')\]]*{white}+|[。！？]+|\n+){white}*"
    ahead = max(min_words, sentence_spans.MIN_SENTENCES)
    alone = sentence_spans.ALONE
    return f"""
WITH texts AS (
  SELECT DISTINCT doc_id, text FROM documents WHERE text <> ''
), parts AS (
  SELECT doc_id, text, unnest(parts) AS part, generate_subscripts(parts, 1) AS pos
  FROM (SELECT *, regexp_extract_all(text, '(?s:.*?){end}|(?s:.+)') AS parts FROM texts)
), plain AS (
  SELECT doc_id, text, pos, regexp_replace(part, '^{white}+|{white}+$', '', 'g') AS plain FROM parts
), kept AS (
  SELECT *, 2 * length(plain) - length(replace(plain, ' ', '')) - length(regexp_replace(plain, '[{alone}]', '', 'g')) + 1 AS size,
         row_number() OVER (PARTITION BY doc_id, text ORDER BY pos) AS i
  FROM plain WHERE plain <> ''
), ahead AS (
  SELECT doc_id, text, i, pos, size,
         list(size) OVER w AS sizes, list(plain) OVER w AS plains, list(pos) OVER w AS places
  FROM kept
  WINDOW w AS (PARTITION BY doc_id, text ORDER BY i ROWS BETWEEN CURRENT ROW AND {ahead - 1} FOLLOWING)
), lengths AS (
  SELECT *, CASE WHEN size >= {long_words} THEN 1
                 ELSE greatest({sentence_spans.MIN_SENTENCES},
                               list_position(list_transform(range(1, len(sizes) + 1),
                                 lambda k: list_sum(list_slice(sizes, 1, k)) >= {min_words}), true)) END AS n,
         list_sum(sizes) AS words
  FROM ahead
), runs AS (
  SELECT doc_id, text, i, pos AS first, places[n] AS last, list_slice(plains, 1, n) AS run
  FROM lengths WHERE n <= len(sizes) AND (size >= {long_words} OR words >= {min_words})
), placed AS (
  SELECT *, row_number() OVER (PARTITION BY run ORDER BY doc_id NULLS FIRST, text, i) AS place FROM runs
), removed AS (
  SELECT DISTINCT doc_id, text, unnest(range(first, last + 1)) AS pos FROM placed WHERE place > 1
), cleaned AS (
  SELECT p.doc_id, p.text AS old, coalesce(string_agg(p.part, '' ORDER BY p.pos) FILTER (r.pos IS NULL), '') AS text,
         count(r.pos) AS n_removed
  FROM parts p LEFT JOIN removed r ON p.doc_id IS NOT DISTINCT FROM r.doc_id AND p.text = r.text AND p.pos = r.pos
  GROUP BY p.doc_id, p.text
)
SELECT d.doc_id, coalesce(c.text, d.text) AS text, CAST(coalesce(c.n_removed, 0) AS BIGINT) AS n_removed
FROM documents d LEFT JOIN cleaned c ON d.doc_id IS NOT DISTINCT FROM c.doc_id AND d.text = c.old
"""
