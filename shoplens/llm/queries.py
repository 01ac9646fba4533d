"""Registered queries of the operators, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from shoplens.llm import (
    bpe, exact_dedup, html_text, importance, langid, lbl, packing, quality, simhash, suffix_dedup, token_counts, token_store,
    variants,
)
from shoplens.llm.tables import documents

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}

# fixed values: remainders of the CRC-32 polynomial 0xEDB88320 for the 16 values of four bits
_CRC_REMAINDERS = ("[0, 498536548, 997073096, 651767980, 1994146192, 1802195444, 1303535960, 1342533948, 3988292384, "
                   "4027552580, 3604390888, 3412177804, 2607071920, 2262029012, 2685067896, 3183342108]")


def _crc32(text: str) -> str:
    """SQL of the unsigned CRC-32 of a string expression's UTF-8 bytes, four bits at a time."""
    half = "instr('0123456789ABCDEF', {}) - 1"
    halves = (f"flatten(list_transform(regexp_extract_all(hex({text}), '..'), "
              f"lambda b: [{half.format('b[2]')}, {half.format('b[1]')}]))")
    return (f"xor(4294967295, list_reduce({halves}, "
            f"lambda c, x: xor(c >> 4, {_CRC_REMAINDERS}[(xor(c, x) & 15) + 1]), 4294967295::BIGINT))")


def _mod(expression: str) -> str:
    """SQL of a 128-bit unsigned expression's low 64 bits."""
    return f"(({expression}) % 18446744073709551616::UHUGEINT)::UBIGINT"


def _times(a: str, b: str) -> str:
    return _mod(f"({a})::UHUGEINT * {b}::UHUGEINT")


def _plus(a: str, b: str) -> str:
    return _mod(f"({a})::UHUGEINT + {b}::UHUGEINT")


def _turned(a: str, bits: int) -> str:
    """Rotation to the left: 2^64 is 1 modulo 2^64 - 1 (right for all values but 2^64 - 1 itself)."""
    return f"(({a})::UHUGEINT * {1 << bits}::UHUGEINT % 18446744073709551615::UHUGEINT)::UBIGINT"


# fixed values: the five primes of XXH64
_P1, _P2, _P3, _P4, _P5 = ("11400714785074694791", "14029467366897019727", "1609587929392839161",
                           "9650029242287828579", "2870177450012600261")


def _xxh64_ctes(source: str, name: str, seed: int) -> str:
    """SQL of the common table expressions that give ``name`` (f, h): the unsigned XXH64 of
    the UTF-8 bytes of the distinct strings f of ``source``."""
    p1, p2 = int(_P1), int(_P2)
    starts = [(seed + p1 + p2) % (1 << 64), (seed + p2) % (1 << 64), seed, (seed - p1) % (1 << 64)]
    taken_in = _times(_turned(_times("x", _P2), 31), _P1)
    lanes = [f"list_reduce(list_slice(lanes, {i + 1}, stripes * 4, 4), lambda c, x: "
             f"{_times(_turned(_plus('c', '(' + _times('x', _P2) + ')'), 31), _P1)}, {start}::UBIGINT)" for i, start in enumerate(starts)]
    merged = _mod(" + ".join(f"{_turned(f'a{i}', r)}::UHUGEINT" for i, r in enumerate((1, 7, 12, 18))))
    for i in range(4):
        merged = _plus(_times(f"xor({merged}, {_times(_turned(_times(f'a{i}', _P2), 31), _P1)})", _P1), _P4)
    return f"""
{name}_bytes AS (
    SELECT f, regexp_extract_all(hex(f), '..') AS bytes, strlen(f) AS n, strlen(f) // 32 AS stripes FROM (SELECT DISTINCT f FROM {source})),
{name}_lanes AS (
    SELECT f, n, stripes, n % 8 // 4 AS fours,
           list_transform(range(n // 8), lambda i: ('0x' || array_to_string(list_reverse(list_slice(bytes, 8 * i + 1, 8 * i + 8)), ''))::UBIGINT) AS lanes,
           ('0x' || array_to_string(list_reverse(list_slice(bytes, n // 8 * 8 + 1, n // 8 * 8 + 4)), '')) AS half,
           list_transform(list_slice(bytes, n // 4 * 4 + 1, n), lambda b: ('0x' || b)::UBIGINT) AS ends
    FROM {name}_bytes),
{name}_striped AS (
    SELECT *, {", ".join(f"{lane} AS a{i}" for i, lane in enumerate(lanes))} FROM {name}_lanes),
{name}_merged AS (
    SELECT f, lanes, stripes, fours, half, ends, {_plus(f"CASE WHEN stripes > 0 THEN {merged} ELSE {(seed + int(_P5)) % (1 << 64)}::UBIGINT END", "n")} AS c
    FROM {name}_striped),
{name}_eights AS (
    SELECT f, fours, half, ends, list_reduce(list_slice(lanes, stripes * 4 + 1, len(lanes)), lambda c, x: {_plus(_times(_turned(f"xor(c, {taken_in})", 27), _P1), _P4)}, c) AS c
    FROM {name}_merged),
{name}_fours AS (
    SELECT f, ends, CASE WHEN fours = 0 THEN c
                         ELSE {_plus(_times(_turned(f"xor(c, {_times('half::UBIGINT', _P1)})", 23), _P2), _P3)} END AS c
    FROM {name}_eights),
{name}_ends AS (
    SELECT f, list_reduce(ends, lambda c, x: {_times(_turned(f"xor(c, {_times('x', _P5)})", 11), _P1)}, c) AS c FROM {name}_fours),
{name}_mixed AS (SELECT f, {_times("xor(c, c >> 33)", _P2)} AS c FROM {name}_ends),
{name}_again AS (SELECT f, {_times("xor(c, c >> 29)", _P3)} AS c FROM {name}_mixed),
{name} AS (SELECT f, xor(c, c >> 32) AS h FROM {name}_again)"""


# SQL of the number whose bits are those set in over half the values h of a group
_MAJORITY = " + ".join(f"CASE WHEN 2 * sum((h >> {bit}) & 1) > count(*) THEN {1 << bit}::HUGEINT ELSE 0 END" for bit in range(64))


def _lowered(text: str) -> str:
    return f"translate(coalesce({text}, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


@query
def op1_best_fit_packing(spark, sf_dir):
    return packing.best_fit_pack(documents(spark, sf_dir))


@query
def op2_token_counts(spark, sf_dir):
    return token_counts.count_tokens(documents(spark, sf_dir), public_tokenizers.path("word_bpe_49k.json"))


@query
def op3_exact_dedup(spark, sf_dir):
    return exact_dedup.dedup(documents(spark, sf_dir))


SQL["op3_exact_dedup"] = r"""
WITH d AS (SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS h FROM documents)
SELECT doc_id, min(doc_id) OVER (PARTITION BY h) AS keep_id, count(*) OVER (PARTITION BY h) AS group_size,
       doc_id = min(doc_id) OVER (PARTITION BY h) AS kept, h AS text_sha256
FROM d
"""


@query
def op4_lbl_scores(spark, sf_dir):
    return lbl.score_documents(documents(spark, sf_dir))


@query
def op5_byte_bpe(spark, sf_dir):
    return bpe.encode_and_decode(documents(spark, sf_dir), public_tokenizers.path("byte_bpe_multi_50k.tiktoken"),
                                 public_tokenizers.PATTERN)


@query
def op6_token_ids(spark, sf_dir):
    path = public_tokenizers.path("byte_bpe_50k.json")
    return token_store.write_store(documents(spark, sf_dir), path, end_id=2).read_all()


@query
def op7_quality_rules(spark, sf_dir):
    return quality.measure(documents(spark, sf_dir))


SQL["op7_quality_rules"] = r"""
WITH docs AS (
    SELECT row_number() OVER () AS row, doc_id, coalesce(text, '') AS text,
           regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
words AS (SELECT row, unnest(w) AS w, generate_subscripts(w, 1) AS i FROM docs),
numbered AS (SELECT row, i, w, dense_rank() OVER (ORDER BY w) AS v FROM words),
windows AS (
    SELECT row, i, list(v) OVER onward AS eight, count(*) OVER onward AS n FROM numbered
    WINDOW onward AS (PARTITION BY row ORDER BY i ROWS BETWEEN CURRENT ROW AND 7 FOLLOWING)),
twice AS (SELECT row, i FROM (SELECT row, i, count(*) OVER (PARTITION BY row, eight) AS times FROM windows WHERE n = 8) WHERE times > 1),
inside AS (
    SELECT row, w, coalesce(i - max(t.i) OVER (PARTITION BY row ORDER BY i) < 8, false) AS repeated
    FROM numbered LEFT JOIN twice t USING (row, i)),
sums AS (
    SELECT row, count(*) AS n_words, sum(length(w))::BIGINT AS word_chars, count(*) FILTER (repeated) AS n_repeat_words,
           coalesce(sum(strlen(w)) FILTER (repeated), 0)::DOUBLE / sum(strlen(w))::DOUBLE AS repeat_char_fraction
    FROM inside GROUP BY row),
-- pairs of equal words at one distance, and the longest unbroken run of them
pairs AS (
    SELECT a.row, b.i - a.i AS distance, a.i - row_number() OVER (PARTITION BY a.row, b.i - a.i ORDER BY a.i) AS run
    FROM numbered a JOIN numbered b ON a.row = b.row AND a.v = b.v AND a.i < b.i),
longest AS (SELECT row, max(n) AS longest_repeat FROM (SELECT row, count(*) AS n FROM pairs GROUP BY row, distance, run) GROUP BY row),
lines AS (SELECT row, unnest(string_split(text, chr(10))) AS line FROM docs),
dup_lines AS (
    SELECT row, count(*) - count(DISTINCT line) AS n_dup_lines FROM lines
    WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY row),
measured AS (
    SELECT doc_id, coalesce(n_words, 0) AS n_words, coalesce(word_chars, 0) AS word_chars,
           len(regexp_extract_all(text, '[#*$%&|<>]'))::BIGINT AS n_symbols, coalesce(n_dup_lines, 0) AS n_dup_lines,
           coalesce(n_repeat_words, 0) AS n_repeat_words, coalesce(repeat_char_fraction, 0) AS repeat_char_fraction,
           coalesce(longest_repeat, 0) AS longest_repeat
    FROM docs LEFT JOIN sums USING (row) LEFT JOIN longest USING (row) LEFT JOIN dup_lines USING (row)),
judged AS (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM measured)
SELECT *, NOT base_failed AND NOT (n_repeat_words > 50 AND repeat_char_fraction > 0.2::DOUBLE)
          AND NOT (longest_repeat > 50 AND longest_repeat > 0.1::DOUBLE * n_words) AS kept
FROM judged
"""


@query
def op8_suffix_dedup(spark, sf_dir):
    return suffix_dedup.removed_repeats(spark.read.parquet(f"{sf_dir}/documents.parquet"))


SQL["op8_suffix_dedup"] = """
WITH docs AS (SELECT row_number() OVER () AS row, doc_id, hex(coalesce(text, '')) AS h, strlen(coalesce(text, '')) AS n_bytes FROM documents),
blocks AS (
    SELECT row, base, substr(h, 2 * base + 1, 2 * 1399) AS h
    FROM (SELECT row, h, unnest(range(0, greatest(n_bytes - 399, 0), 1000)) AS base FROM docs)),
starts AS (
    SELECT row, base + i AS p, md5(substr(h, 2 * i - 1, 800)) AS string
    FROM (SELECT row, base, h, unnest(generate_series(1, least(1000, strlen(h) // 2 - 399))) AS i FROM blocks)),
repeated AS (SELECT row, p FROM (SELECT row, p, count(*) OVER (PARTITION BY string) AS n FROM starts) WHERE n > 1),
numbered AS (
    SELECT row, p, sum(opens) OVER (PARTITION BY row ORDER BY p) AS span
    FROM (SELECT row, p, CASE WHEN p <= lag(p) OVER (PARTITION BY row ORDER BY p) + 400 THEN 0 ELSE 1 END AS opens FROM repeated)),
spans AS (SELECT row, min(p) AS first, max(p) + 399 AS last FROM numbered GROUP BY row, span),
gaps AS (SELECT *, coalesce(lag(last) OVER (PARTITION BY row ORDER BY first), 0) AS before FROM spans),
cut AS (
    SELECT row, sum(last - first + 1)::BIGINT AS n_removed, count(*) AS n_spans,
           string_agg(substr(h, 2 * before + 1, 2 * (first - before - 1)), '' ORDER BY first) || substr(any_value(h), 2 * max(last) + 1) AS kept
    FROM gaps JOIN docs USING (row) GROUP BY row)
SELECT doc_id, n_bytes, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans,
       sha256(unhex(coalesce(kept, h))) AS kept_sha256, n_bytes - coalesce(n_removed, 0) AS n_kept, n_removed IS NOT NULL AS changed
FROM docs LEFT JOIN cut USING (row)
"""


@query
def op9_simhash(spark, sf_dir):
    return simhash.near_duplicates(documents(spark, sf_dir))


SQL["op9_simhash"] = rf"""
WITH RECURSIVE split AS (
    SELECT row_number() OVER () AS row, doc_id, regexp_extract_all({_lowered("text")}, '[^\x20\x09-\x0D]+') AS w FROM documents),
shingles AS (
    SELECT row, array_to_string(list_slice(w, i, i + 2), ' ') AS f
    FROM (SELECT row, w, unnest(generate_series(1, greatest(len(w) - 2, least(len(w), 1)))) AS i FROM split)),
{_xxh64_ctes("shingles", "hashes", 42)},
prints AS (SELECT row, ({_MAJORITY})::UBIGINT AS fp FROM shingles JOIN hashes USING (f) GROUP BY row),
docs AS (SELECT doc_id, coalesce(fp, 0) AS fp FROM split LEFT JOIN prints USING (row)),
nodes AS (SELECT fp, min(doc_id) AS first, count(*) AS n FROM docs GROUP BY fp),
links AS (SELECT a.fp, b.fp AS near FROM nodes a JOIN nodes b ON bit_count(xor(a.fp, b.fp)::HUGEINT) <= 2),
reached AS (SELECT fp, fp AS near FROM nodes UNION SELECT reached.fp, links.near FROM reached JOIN links ON links.fp = reached.near),
components AS (
    SELECT reached.fp, min(first) AS component_id, sum(n)::BIGINT AS group_size
    FROM reached JOIN nodes ON nodes.fp = reached.near GROUP BY reached.fp)
SELECT doc_id, lpad(lower(to_hex(fp)), 16, '0') AS fingerprint, component_id, group_size FROM docs JOIN components USING (fp)
"""


@query
def op10_language_id(spark, sf_dir):
    return langid.predict_languages(spark.read.parquet(f"{sf_dir}/documents.parquet"))


@query
def op11_importance_resampling(spark, sf_dir):
    docs, target = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "benchmark"))
    return importance.resample(docs, target).select("doc_id", "n_features", "weight", "score", "rank")


SQL["op11_importance_resampling"] = rf"""
WITH texts AS (
    SELECT row_number() OVER () AS row, doc_id, text, true AS of_docs FROM documents
    UNION ALL SELECT row_number() OVER (), NULL, text, false FROM benchmark),
split AS (
    SELECT row, doc_id, of_docs, regexp_extract_all({_lowered("text")}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM texts),
words AS (SELECT row, of_docs, unnest(w) AS w, generate_subscripts(w, 1) AS i FROM split),
runs AS (
    SELECT row, of_docs, w AS one, w || ' ' || lead(w) OVER onward AS two,
           w || ' ' || lead(w) OVER onward || ' ' || lead(w, 2) OVER onward AS three
    FROM words WINDOW onward AS (PARTITION BY of_docs, row ORDER BY i)),
features AS (
    SELECT row, of_docs, f FROM (
        SELECT row, of_docs, one AS f FROM runs UNION ALL SELECT row, of_docs, two FROM runs
        UNION ALL SELECT row, of_docs, three FROM runs)
    WHERE f IS NOT NULL),
buckets AS (SELECT f, {_crc32("f")} % 10000 AS bucket FROM (SELECT DISTINCT f FROM features)),
counts AS (
    SELECT bucket, count(*) FILTER (of_docs) AS s, count(*) FILTER (NOT of_docs) AS t
    FROM features JOIN buckets USING (f) GROUP BY bucket),
gains AS (
    SELECT bucket, floor(1000 * ln((t + 1)::DOUBLE * (sum(s) OVER () + 10000)::DOUBLE
                                   / ((s + 1)::DOUBLE * (sum(t) OVER () + 10000)::DOUBLE)))::BIGINT AS gain
    FROM counts),
weights AS (
    SELECT row, count(*) AS n_features, sum(gain)::BIGINT AS weight
    FROM features JOIN buckets USING (f) JOIN gains USING (bucket) WHERE of_docs GROUP BY row),
scored AS (
    SELECT row, doc_id, len(w) >= 20 AS able, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight,
           coalesce(weight, 0) + floor(-1000 * ln(-ln(
               (('0x' || left(sha256('42:' || coalesce(doc_id::VARCHAR, '')), 8))::BIGINT + 0.5::DOUBLE) / 4294967296::DOUBLE)))::BIGINT AS score
    FROM (SELECT * FROM split WHERE of_docs) LEFT JOIN weights USING (row)),
ranked AS (
    SELECT *, row_number() OVER (PARTITION BY able ORDER BY score DESC, doc_id NULLS LAST, n_features DESC) AS place,
           count(*) FILTER (able) OVER () AS n_able
    FROM scored)
SELECT doc_id, n_features, weight, score, CASE WHEN able AND place <= 5 * n_able // 100 THEN place END AS rank FROM ranked
"""


@query
def op12_spelling_variants(spark, sf_dir):
    return variants.group_variants(documents(spark, sf_dir))


SQL["op12_spelling_variants"] = rf"""
WITH RECURSIVE runs AS (
    SELECT coalesce(doc_id::VARCHAR, '') AS id, unnest(regexp_extract_all({_lowered("text")}, '[a-z\x{{C0}}-\x{{FF}}]+')) AS run
    FROM documents),
hashed AS (SELECT run, count(*) AS k, {_crc32("id || ':' || run")} AS h FROM runs GROUP BY id, run),
slipped AS (
    SELECT k, CASE WHEN h % 97 = 0 THEN left(run, (h % length(run))::BIGINT) || substr(run, (h % length(run) + 2)::BIGINT)
                   ELSE run END AS word FROM hashed),
words AS (
    SELECT word, sum(k)::BIGINT AS n FROM slipped WHERE length(word) >= 5 GROUP BY word HAVING sum(k) >= 3),
cuts AS (
    SELECT word, left(word, i - 1) AS head, substr(word, i + 1) AS rest
    FROM (SELECT word, unnest(generate_series(1, length(word))) AS i FROM words)),
less AS (SELECT DISTINCT c.word, w.word AS near FROM cuts c JOIN words w ON w.word = c.head || c.rest),
near AS (
    SELECT a.word, b.word AS near FROM cuts a JOIN cuts b ON a.head = b.head AND a.rest = b.rest AND a.word <> b.word
    UNION SELECT word, near FROM less UNION SELECT near, word FROM less),
best AS (
    SELECT near.word, near.near, w.n, count(*) OVER (PARTITION BY near.word) AS n_near,
           row_number() OVER (PARTITION BY near.word ORDER BY w.n DESC, near.near) AS place
    FROM near JOIN words w ON w.word = near.near),
forms AS (
    SELECT w.word, w.n, coalesce(b.n_near, 0) AS n_near, CASE WHEN b.n >= 2 * w.n THEN b.near END AS form,
           CASE WHEN b.n >= 2 * w.n THEN b.n END AS form_n
    FROM words w LEFT JOIN best b ON b.word = w.word AND b.place = 1),
way AS (
    SELECT word, word AS root, form AS following FROM forms
    UNION ALL SELECT way.word, forms.word, forms.form FROM way JOIN forms ON forms.word = way.following)
SELECT word, form, root, n, n_near, form_n FROM forms JOIN (SELECT word, root FROM way WHERE following IS NULL) USING (word)
"""


@query
def op13_html_extraction(spark, sf_dir):
    return html_text.extract(spark.read.parquet(f"{sf_dir}/pages.parquet"))
