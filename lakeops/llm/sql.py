"""SQL (for DuckDB) that must give the rows of the operators that SQL can express."""

from __future__ import annotations

from . import quality_rules as q, sharding as s

# --- quality rules ------------------------------------------------------------------------

_DIMS = range(len(q.STATS))
_PAIRS = [(i, j) for i in _DIMS for j in range(i + 1)]
_SPACE_SQL = " || ".join(f"chr({ord(c)})" for c in q.SPACES)


def _fixed(value: str) -> str:
    return f"floor(({value}) * {q.UNIT} + 0.5)::BIGINT"


def _distance(source: str, where: str = "") -> str:
    """``source`` with the squared distance ``d2``, one column of the solution after the other."""
    for i in _DIMS:
        left = f"({q.STATS[i]}::DOUBLE / {q.UNIT} - m{i})"
        for j in range(i):
            left = f"({left} - l{i}{j} * y{j})"
        source = f"(SELECT *, {left} / l{i}{i} AS y{i} FROM {source} {where if i == 0 else ''})"
    total = "y0 * y0"
    for i in _DIMS[1:]:
        total = f"({total} + y{i} * y{i})"
    return f"(SELECT *, {total} AS d2 FROM {source})"


def _concentrated(before: str) -> str:
    factor = q.core_factor(q.CORE, len(q.STATS))
    sums = ", ".join([f"sum({q.STATS[i]}) AS a{i}" for i in _DIMS]
                     + [f"sum({q.STATS[i]} * {q.STATS[j]}) AS a{i}{j}" for i, j in _PAIRS])
    names = [f"a{i}" for i in _DIMS] + [f"a{i}{j}" for i, j in _PAIRS]
    out = (f"(SELECT g, far, count(*) AS n, {sums} FROM (SELECT *, floor({q.CLASSES} * log2(1 + d2))::INTEGER AS far "
           f"FROM {_distance(f'(SELECT r.*, e.* EXCLUDE (g) FROM leveled r JOIN {before} e ON e.g = r.g)')}) GROUP BY 1, 2)")
    out = (f"(SELECT *, sum(n) OVER (PARTITION BY g ORDER BY far) - n AS nearer, sum(n) OVER (PARTITION BY g) AS everyone FROM {out})")
    out = (f"(SELECT g, max(everyone) AS rows, sum(n)::DOUBLE AS n, {', '.join(f'sum({a})::DOUBLE AS {a}' for a in names)} FROM {out} "
           f"WHERE nearer < ceil(everyone * {q.CORE}::DOUBLE) GROUP BY g)")
    out = f"(SELECT *, {', '.join(f'a{i} / n / {q.UNIT} AS m{i}' for i in _DIMS)} FROM {out})"
    shared = [f"(a{i}{j} / n / {q.UNIT} / {q.UNIT} - m{i} * m{j}) * {factor!r}::DOUBLE AS c{i}{j}" for i, j in _PAIRS]
    out = _rooted(f"(SELECT *, {', '.join(shared)} FROM {out})")
    kept = [f"m{i}" for i in _DIMS] + [f"{k}{i}{j}" for k in "cl" for i, j in _PAIRS]
    return f"SELECT g, rows, {', '.join(kept)} FROM {out}"


def _rooted(out: str) -> str:
    for i, j in _PAIRS:
        left = f"(c{i}{j} + {q.LEAST_SPREAD[i] ** 2!r}::DOUBLE)" if i == j else f"c{i}{j}"
        for k in range(j):
            left = f"({left} - l{i}{k} * l{j}{k})"
        out = f"(SELECT *, {f'sqrt({left})' if i == j else f'{left} / l{j}{j}'} AS l{i}{j} FROM {out})"
    return out


def _leaning(own: str, wider: str, on: str) -> str:
    """Estimates mixed with those of the wider group, by the number of rows."""
    names = [f"m{i}" for i in _DIMS] + [f"c{i}{j}" for i, j in _PAIRS]
    share = f"(o.rows::DOUBLE / (o.rows + {q.WIDER_ROWS}))"
    return (f"SELECT o.g, {', '.join(f'{share} * o.{c} + (1 - {share}) * w.{c} AS {c}' for c in names)} "
            f"FROM {own} o JOIN {wider} w ON {on}")


def quality_sql() -> str:
    word = q.WORD.replace("\\", "\\")
    start = ", ".join(
        f"max(CASE WHEN dim = {i} THEN middle END)::DOUBLE / {q.UNIT} AS m{i}, "
        f"greatest(max(CASE WHEN dim = {i} THEN high - low END)::DOUBLE / {q.UNIT} / 1.349::DOUBLE, {q.LEAST_SPREAD[i]!r}::DOUBLE) AS l{i}{i}"
        for i in _DIMS) + "".join(f", 0.0::DOUBLE AS l{i}{j}" for i, j in _PAIRS if i != j)
    cut = lambda quarters, name: f"min(CASE WHEN upto * 4 >= everyone * {quarters} THEN v END) AS {name}"
    steps = []
    for n in range(q.STEPS):
        steps.append(f"e{n + 1} AS MATERIALIZED ({_concentrated(f'e{n}')})")
    limit = q.chi2_quantile(1 - q.TAIL, len(q.STATS))
    return f"""
WITH texts AS (SELECT row_number() OVER () AS id, doc_id, coalesce(text, '') AS t, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
  lang IS NULL AS no_lang, source IS NULL AS no_source FROM documents),
split AS MATERIALIZED (SELECT *, regexp_extract_all(t, '{word}') AS words,
  list_filter(string_split(t, chr(10)), lambda x: translate(x, {_SPACE_SQL}, '') <> '') AS lines FROM texts),
runs AS (SELECT id, i, words[i] || ' ' || words[i + 1] || ' ' || words[i + 2] AS run
  FROM (SELECT id, words, unnest(range(1, len(words) - 1)) AS i FROM split)),
again AS (SELECT id, i FROM (SELECT *, count(*) OVER (PARTITION BY id, run) AS n FROM runs) WHERE n > 1),
covered AS (SELECT id, count(DISTINCT place) AS n FROM (SELECT id, i + unnest([0, 1, 2]) AS place FROM again) GROUP BY 1),
base AS (SELECT s.id, doc_id, lang, source, no_lang, no_source, len(words)::BIGINT AS n_words,
  length(translate(t, {_SPACE_SQL}, ''))::BIGINT AS word_chars, (length(t) - length(translate(t, '{q.SYMBOLS}', '')))::BIGINT AS n_symbols,
  len(lines)::BIGINT AS n_lines, (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines, coalesce(c.n, 0)::BIGINT AS n_repeat_words
  FROM split s LEFT JOIN covered c ON c.id = s.id),
stats AS MATERIALIZED (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
  {_fixed('ln(greatest(1, word_chars) / greatest(1, n_words)::DOUBLE)')} AS s_word,
  {_fixed('ln(0.02::DOUBLE + n_symbols / greatest(1, n_words)::DOUBLE)')} AS s_symbol,
  {_fixed('ln(0.02::DOUBLE + n_repeat_words / greatest(1, n_words)::DOUBLE)')} AS s_repeat,
  {_fixed('ln(0.02::DOUBLE + n_dup_lines / greatest(1, n_lines)::DOUBLE)')} AS s_line,
  to_json([no_lang::VARCHAR, lang, no_source::VARCHAR, source])::VARCHAR AS fine, to_json([no_lang::VARCHAR, lang])::VARCHAR AS wide FROM base),
levels AS MATERIALIZED (SELECT DISTINCT fine, wide FROM stats),
leveled AS MATERIALIZED (SELECT unnest([fine, wide, '']) AS g, {', '.join(q.STATS)} FROM stats),
ranked AS (SELECT g, dim, v, sum(n) OVER (PARTITION BY g, dim ORDER BY v) AS upto, sum(n) OVER (PARTITION BY g, dim) AS everyone FROM (
  SELECT g, dim, v, count(*) AS n FROM ({' UNION ALL '.join(f'SELECT g, {i} AS dim, {c} AS v FROM leveled' for i, c in enumerate(q.STATS))}) GROUP BY 1, 2, 3)),
spread AS (SELECT g, dim, {cut(1, 'low')}, {cut(2, 'middle')}, {cut(3, 'high')} FROM ranked GROUP BY 1, 2),
e0 AS MATERIALIZED (SELECT g, {start} FROM spread GROUP BY g),
{', '.join(steps)},
langs AS ({_leaning(f"(SELECT * FROM e{q.STEPS} WHERE g IN (SELECT wide FROM levels))", f"e{q.STEPS}", "w.g = ''")}),
judge AS MATERIALIZED (SELECT * FROM {_rooted('(' + _leaning(f"(SELECT * FROM e{q.STEPS} JOIN levels ON fine = g)", "langs", "w.g = o.wide") + ')')})
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND d2 <= {limit!r}::DOUBLE AS kept, floor(d2 * 1e6 + 0.5) / 1e6 AS distance
FROM {_distance('(SELECT s.*, e.* EXCLUDE (g) FROM stats s JOIN judge e ON e.g = s.fine)')}"""


# --- Hilbert shards -----------------------------------------------------------------------


def _crc_table() -> list[int]:
    """The table of the reflected polynomial that CRC-32 is defined by."""
    table = []
    for n in range(256):
        for _ in range(8):
            n = n >> 1 ^ (0xEDB88320 if n & 1 else 0)
        table.append(n)
    return table


def _crc(value: str) -> str:
    """CRC-32 of a text's UTF-8 bytes, byte by byte."""
    digits = f"hex(encode({value}))"
    codes = f"list_transform(range(0, octet_length(encode({value}))), lambda i: ('0x' || substr({digits}, 2 * i + 1, 2))::BIGINT)"
    step = "lambda a, x: xor(a >> 8, crc_table[(xor(a, x) & 255) + 1])"
    return f"xor(list_reduce(list_prepend(4294967295::BIGINT, {codes}), {step}), 4294967295::BIGINT)"


def _curve(source: str, dims: int, bits: int) -> str:
    low = (1 << bits) - 1
    source = f"(SELECT *, {', '.join(f'(cell >> {bits * (dims - 1 - i)}) & {low} AS x{i}' for i in range(dims))} FROM {source})"
    for at in range(bits - 1, 0, -1):
        rest = (1 << at) - 1
        for i in range(dims):
            flip, swap = f"(x{i} >> {at}) & 1 = 1", f"(xor(x0, x{i}) & {rest})"
            new = f"CASE WHEN {flip} THEN xor(x0, {rest}) ELSE xor(x0, {swap}) END AS x0"
            if i:
                new += f", CASE WHEN {flip} THEN x{i} ELSE xor(x{i}, {swap}) END AS x{i}"
            source = f"(SELECT * REPLACE ({new}) FROM {source})"
    for i in range(1, dims):
        source = f"(SELECT * REPLACE (xor(x{i}, x{i - 1}) AS x{i}) FROM {source})"
    gray = "0"
    for at in range(bits - 1, 0, -1):
        gray = f"xor({gray}, CASE WHEN (x{dims - 1} >> {at}) & 1 = 1 THEN {(1 << at) - 1} ELSE 0 END)"
    source = f"(SELECT *, {gray} AS gray FROM {source})"
    index = "0"
    for at in range(bits - 1, -1, -1):
        for i in range(dims):
            index = f"({index} * 2 + ((xor(x{i}, gray) >> {at}) & 1))"
    return f"SELECT *, {index} AS curve FROM {source}"


def sharding_sql() -> str:
    most = (1 << s.BITS) - 1
    return f"""
WITH crc AS (SELECT {_crc_table()}::BIGINT[] AS crc_table),
named AS (SELECT name, {_crc('name')} AS code FROM (SELECT DISTINCT unnest([coalesce(lang, ''), coalesce(source, '')]) AS name FROM documents), crc),
bodies AS MATERIALIZED (SELECT t, {_crc('t')} AS code FROM (SELECT DISTINCT coalesce(text, '') AS t FROM documents), crc),
ends AS (SELECT min(doc_id)::DOUBLE AS low, max(doc_id)::DOUBLE AS high FROM documents),
slim AS (SELECT doc_id, octet_length(encode(coalesce(text, '')))::BIGINT + 1 AS size, b.code AS text_crc32, l.code & {most} AS x_lang, o.code & {most} AS x_source,
  coalesce(greatest(0, least({most}, floor((doc_id::DOUBLE - low) / (high - low + 1) * {1 << s.BITS}))), 0)::INTEGER AS x_range
  FROM documents d JOIN bodies b ON b.t = coalesce(d.text, '') JOIN named l ON l.name = coalesce(d.lang, '')
  JOIN named o ON o.name = coalesce(d.source, ''), ends),
placed AS (SELECT *, ((x_lang * {most + 1} + x_source) * {most + 1} + greatest(0, least({most}, floor(log2(size::DOUBLE)) - 4))::BIGINT) * {most + 1} + x_range AS cell,
  coalesce(doc_id, text_crc32) AS place FROM slim),
parted AS (SELECT *, (((((xor(xor(place, place >> 31), place >> 62) & {(1 << 31) - 1}) * {s.MIX}) & {(1 << 32) - 1}) >> 8) * {s.PARTS}) >> 24 AS part FROM placed),
cells AS ({_curve('(SELECT DISTINCT cell FROM placed)', 4, s.BITS)}),
ranked AS (SELECT p.*, row_number() OVER (ORDER BY curve, part, place, text_crc32, size) - 1 AS r, count(*) OVER () AS n
  FROM parted p JOIN cells USING (cell))
SELECT doc_id, size, text_crc32, 'rows' AS law, (r * {s.SHARDS} // n)::INTEGER AS shard,
  r - ((r * {s.SHARDS} // n) * n + {s.SHARDS - 1}) // {s.SHARDS} AS slot, NULL::INTEGER AS grown_shard FROM ranked"""


def ranking_sql(top: int = 20) -> str:
    """The best documents of each benchmark item, every document scored."""
    terms = r"regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), " \
            r"'[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"
    return f"""
    WITH doc AS (SELECT doc_id, {terms} AS terms, row_number() OVER () AS d FROM documents WHERE text IS NOT NULL),
    sized AS (SELECT d, doc_id, CAST(len(terms) AS BIGINT) AS n FROM doc WHERE len(terms) > 0),
    totals AS (SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS all_terms FROM sized),
    item AS (SELECT item_id, i, unnest(terms) AS term
             FROM (SELECT item_id, row_number() OVER () AS i, {terms} AS terms FROM benchmark WHERE text IS NOT NULL)),
    asked AS (SELECT item_id, i, term, count(*) AS often FROM item GROUP BY ALL),
    posting AS (SELECT d, term, count(*) AS tf FROM (SELECT d, unnest(terms) AS term FROM doc)
                WHERE term IN (SELECT term FROM asked) GROUP BY ALL),
    weight AS (SELECT term, CAST(floor(1000 * ln(CAST(2 * docs + 2 AS DOUBLE) / CAST(2 * df + 1 AS DOUBLE))) AS BIGINT) AS w
               FROM (SELECT term, count(*) AS df FROM posting GROUP BY ALL), totals),
    scored AS (SELECT item_id, i, d, doc_id, CAST(sum(often * w *
                   ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * n * docs) // all_terms)))) AS BIGINT) AS score
               FROM asked JOIN weight USING (term) JOIN posting USING (term) JOIN sized USING (d), totals GROUP BY ALL),
    ranked AS (SELECT *, row_number() OVER (PARTITION BY i ORDER BY score DESC, doc_id NULLS LAST, d) AS place
               FROM scored WHERE score > 0)
    SELECT item_id, CAST(place AS INTEGER) AS rank, doc_id, score FROM ranked WHERE place <= {top}"""
