"""DuckDB SQL for the operators that SQL can express, over whole tables and whole texts."""

from beatgrid.llm import decontaminate, merkle_manifest, mixing, positions, sharding

UPPER, LOWER = merkle_manifest.UPPER, merkle_manifest.LOWER


def leading(text: str, digits: int) -> str:
    """The first hex digits of the text's MD5 as a number."""
    return f"CAST('0x' || substr(md5({text}), 1, {digits}) AS BIGINT)"


KEY = "coalesce(CAST(doc_id AS VARCHAR), 'null')"

# The table of CRC-32 by its rule, and the checksum of a text's bytes.
CRC_TABLE = """
    SELECT list_transform(range(0, 256), lambda i: list_reduce(list_concat([i], range(0, 8)),
               lambda c, k: CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS crc_table"""


def crc32(text: str) -> str:
    return f"""xor(list_reduce(list_concat([CAST(4294967295 AS BIGINT)],
                   list_transform(regexp_extract_all(hex(encode({text})), '..'), lambda b: CAST('0x' || b AS BIGINT))),
                   lambda c, b: xor(c >> 8, crc_table[1 + (xor(c, b) & 255)])), 4294967295)"""


# --- decontamination -------------------------------------------------------------

_WORDS = f"regexp_extract_all(translate(text, '{UPPER}', '{LOWER}'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"
_SLICED = "array_to_string(words[i:i + size - 1], ' ')"

BENCHMARK_HITS = f"""
    WITH items AS (SELECT coalesce(CAST(item_id AS VARCHAR), 'null') AS item, {_WORDS} AS words FROM benchmark WHERE text IS NOT NULL),
    sized AS (SELECT *, least({decontaminate.WINDOW}, len(words)) AS size FROM items WHERE len(words) > 0),
    windows AS (SELECT DISTINCT item, size, {_SLICED} AS win
                FROM (SELECT *, unnest(range(1, len(words) - size + 2)) AS i FROM sized)),
    docs AS (SELECT row_number() OVER () AS rid, doc_id, coalesce({_WORDS}, []) AS words FROM documents),
    spread AS (SELECT rid, size, words, unnest(range(1, len(words) - size + 2)) AS i
               FROM docs, (SELECT DISTINCT size FROM windows) WHERE len(words) >= size),
    found AS (SELECT rid, i, f.size, item FROM (SELECT rid, i, size, {_SLICED} AS win FROM spread) f JOIN windows w ON f.win = w.win AND f.size = w.size),
    hit AS (SELECT rid, count(DISTINCT spot) AS n_hit FROM (SELECT rid, unnest(range(i, i + size)) AS spot FROM found) GROUP BY rid),
    named AS (SELECT rid, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS names FROM (SELECT DISTINCT rid, item FROM found) GROUP BY rid)
    SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
           sha256(coalesce(names, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
    FROM docs LEFT JOIN hit USING (rid) LEFT JOIN named USING (rid)"""


# --- mixing ------------------------------------------------------------------------

SOURCE_MIX = f"""
    WITH sized AS (SELECT doc_id, CASE WHEN source IS NULL THEN '1' ELSE '0' || source END AS src,
                          coalesce(CAST(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')) AS BIGINT), 0) AS size,
                          {leading(KEY, 8)} AS spread FROM documents),
    classed AS (SELECT *, greatest(length(bin(size)) - 6, 0) AS shift FROM sized),
    grouped AS (SELECT *, shift * 32 + (size >> shift) AS class, ceil(count(*) OVER (PARTITION BY src, shift * 32 + (size >> shift)) / {positions.BUCKET_ROWS}) AS buckets FROM classed),
    placed AS (SELECT *, row_number() OVER (PARTITION BY src ORDER BY class, floor(spread * buckets / {positions.SPREAD}), size, doc_id NULLS FIRST) - 1 AS spot FROM grouped),
    sources AS (SELECT src, CAST(sum(size) AS BIGINT) AS whole, ([{', '.join(map(str, mixing.WEIGHTS))}])[1 + (row_number() OVER (ORDER BY src) - 1) % {len(mixing.WEIGHTS)}] AS weight
                FROM sized GROUP BY src),
    open AS (SELECT *, {mixing.LIMIT} * whole AS cap,
                    CAST(sum(whole) OVER () - coalesce(sum({mixing.LIMIT} * whole) OVER w, 0) AS BIGINT) AS remaining,
                    CAST(sum(weight) OVER () - coalesce(sum(weight) OVER w, 0) AS BIGINT) AS shares
             FROM sources WINDOW w AS (ORDER BY {mixing.LIMIT} * whole / weight, src ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
    first AS (SELECT remaining AS r0, shares AS s0 FROM open WHERE cap * shares > remaining * weight ORDER BY cap / weight, src LIMIT 1),
    targets AS (SELECT src, whole, CASE WHEN s0 IS NULL OR NOT cap * shares > remaining * weight THEN CAST(cap AS DOUBLE) ELSE r0 * weight / s0 END AS target
                FROM open LEFT JOIN first ON true),
    rated AS (SELECT *, CASE WHEN whole > 0 THEN target / whole ELSE 0.0 END AS rate,
                     floor({leading(f"'{mixing.SEED}:' || src", 8)} * {mixing.STEPS} / {positions.SPREAD}) / {mixing.STEPS} AS start FROM targets)
    SELECT doc_id, size, whole AS source_size, target,
           size * CAST(least(floor(rate * (spot + 1) + start) - floor(rate * spot + start), {mixing.LIMIT}) AS BIGINT) AS taken
    FROM placed JOIN rated USING (src)"""


# --- sharding ----------------------------------------------------------------------

def _winner(shards: int) -> str:
    draws = ", ".join(f"struct_pack(draw := -ln(({leading(f'''{KEY} || ':{s}' ''', 12)} + 0.5) / {float(1 << 48)!r}), shard := {s})" for s in range(shards))
    return f"list_min([{draws}]).shard"


RENDEZVOUS_SHARDS = f"""
    WITH crc AS ({CRC_TABLE}),
    drawn AS (SELECT doc_id, CAST(strlen(coalesce(text, '')) + 1 AS BIGINT) AS size, CAST({crc32("coalesce(text, '')")} AS BIGINT) AS text_crc32,
                     {_winner(sharding.SHARDS)} AS shard, {_winner(sharding.SHARDS + 1)} AS grown_shard, {leading(KEY, 8)} AS spread, {KEY} AS key
              FROM documents, crc)
    SELECT doc_id, size, text_crc32, 'key' AS law, CAST(shard AS INTEGER) AS shard,
           row_number() OVER (PARTITION BY shard ORDER BY spread, key, text_crc32, size) - 1 AS slot, CAST(grown_shard AS INTEGER) AS grown_shard
    FROM drawn"""


# --- manifest ----------------------------------------------------------------------

def _framed(value: str) -> str:
    return f"coalesce(strlen({value}) || ':' || {value}, '-')"


def _row_digest(text: str) -> str:
    fields = [text if f == "text" else f"CAST({f} AS VARCHAR)" for f in merkle_manifest.FIELDS]
    return "sha256(" + " || ".join(map(_framed, fields)) + ")"


def _levels(name: str, bottom: str, levels: int, fan: int = merkle_manifest.FAN) -> list[str]:
    """Nodes ``<name>0`` to ``<name><levels>`` of (tree, pos, d, size), and the siblings of each level."""
    out = [f"{name}0 AS ({bottom})"]
    for k in range(levels):
        below = f"{name}{k}"
        run = f"OVER (PARTITION BY tree, pos // {fan} ORDER BY pos ROWS BETWEEN"
        out.append(f"""{name}_s{k} AS (SELECT tree, pos,
            coalesce(string_agg(d, '') {run} UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS l,
            coalesce(string_agg(d, '') {run} 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS r FROM {below} WHERE size > 1)""")
        out.append(f"""{name}{k + 1} AS (
            SELECT tree, pos // {fan} AS pos, sha256(string_agg(d, '' ORDER BY pos)) AS d, (any_value(size) + {fan - 1}) // {fan} AS size
            FROM {below} WHERE size > 1 GROUP BY tree, pos // {fan}
            UNION ALL SELECT tree, pos, d, size FROM {below} WHERE size = 1)""")
    return out


def _folds(name: str, start: str, sibling: str, tree: str, pos: str, levels: int, fan: int = merkle_manifest.FAN) -> list[str]:
    """Steps ``<name>0`` and on, which add each level's siblings to ``proof`` and fold them into ``folded``."""
    out = [f"{name}0 AS ({start})"]
    for k in range(levels):
        out.append(f"""{name}{k + 1} AS (
            SELECT f.* EXCLUDE (proof, folded), proof || coalesce(l || r, '') AS proof,
                   CASE WHEN l IS NULL THEN folded ELSE sha256(l || folded || r) END AS folded
            FROM {name}{k} f LEFT JOIN {sibling}_s{k} s ON s.tree = f.{tree} AND s.pos = f.{pos} // {fan ** k})""")
    return out


DEEP, WIDE = 5, 4  # levels for 16**5 rows a source and 16**4 sources
_TAMPERED = f"translate(text, '{UPPER}', '{LOWER}')"
MERKLE_PROOFS = "WITH " + ",\n".join([
    f"crc AS ({CRC_TABLE})",
    f"""hashed AS (SELECT doc_id, coalesce('=' || source, '') AS tree, {_row_digest('text')} AS leaf,
            CASE WHEN {crc32('CAST(doc_id AS VARCHAR)')} % {merkle_manifest.TAMPER_ONE_IN} = 0 THEN {_row_digest(_TAMPERED)} END AS other FROM documents, crc)""",
    """rows_at AS (SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos,
            count(*) OVER (PARTITION BY tree) AS size FROM hashed)""",
    *_levels("n", "SELECT tree, pos, leaf AS d, size FROM rows_at", DEEP),
    f"peaks AS (SELECT tree, d AS subroot, row_number() OVER (ORDER BY tree) - 1 AS top_pos FROM n{DEEP})",
    *_levels("t", "SELECT 'top' AS tree, top_pos AS pos, subroot AS d, count(*) OVER () AS size FROM peaks", WIDE),
    *_folds("f", "SELECT r.*, subroot, top_pos, 'top' AS top, '' AS proof, coalesce(other, leaf) AS folded FROM rows_at r JOIN peaks USING (tree)", "n", "tree", "pos", DEEP),
    *_folds("g", f"SELECT * FROM f{DEEP}", "t", "top", "top_pos", WIDE),
]) + f"""
    SELECT doc_id, leaf, subroot, d AS root, sha256(proof) AS proof_sha256, folded AS folded_root, folded = d AS verified
    FROM g{WIDE}, (SELECT d FROM t{WIDE})"""

ORACLES = {
    "op5_benchmark_hits": BENCHMARK_HITS,
    "op7_source_mix": SOURCE_MIX,
    "op8_rendezvous_shards": RENDEZVOUS_SHARDS,
    "op12_merkle_proofs": MERKLE_PROOFS,
}
