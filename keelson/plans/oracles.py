"""DuckDB SQL for the registered queries, written from the rules and not from the Spark plans.

A chain of common tables goes from the sources to the final relations; each query takes the part it needs.
"""

from __future__ import annotations

from ..functions import vocabulary as W

#: Columns of the driver tables that are profiled, with their kind (i int, f float, t timestamp, s text).
SOURCES = {
    "region": "r_regionkey:i r_name:s",
    "nation": "n_nationkey:i n_name:s n_regionkey:i",
    "customer": "c_custkey:i c_name:s c_nationkey:i c_acctbal:f c_mktsegment:s",
    "supplier": "s_suppkey:i s_name:s s_nationkey:i s_acctbal:f",
    "part": "p_partkey:i p_name:s p_brand:s p_type:s p_size:i p_retailprice:f",
    "orders": "o_orderkey:i o_custkey:i o_orderstatus:s o_totalprice:f o_orderdate:t o_orderpriority:s",
    "lineitem": "l_orderkey:i l_partkey:i l_suppkey:i l_linenumber:i l_quantity:f l_extendedprice:f l_discount:f l_tax:f l_returnflag:s l_linestatus:s l_shipdate:t",
    "events": "event_id:i ts:t user_id:i event_type:s value:f props:s",
    "documents": "doc_id:i text:s lang:s source:s n_chars:i",
    "embeddings": "vec_id:i - label:i",
    "pages": "page_id:i url:s html:s",
    "benchmark": "item_id:i text:s",
    "labels": "doc_id:i quality:i toxic:i",
    "conversations": "conv_id:i turn:i role:s text:s",
}
KIND = {"i": "int", "f": "float", "t": "datetime", "s": "str"}


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _list(words) -> str:
    return "(" + ", ".join(_q(w) for w in words) + ")"


def _any_in(text: str, words) -> str:
    return "(" + " OR ".join(f"contains({text}, {_q(w)})" for w in words) + ")"


def _trim(column: str) -> str:
    return f"trim({column}, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13))"


def _text(column: str, kind: str) -> str:
    return {
        "i": f"CAST({column} AS VARCHAR)",
        "f": f"CASE WHEN {column} = floor({column}) AND abs({column}) < 1e15 THEN CAST(CAST({column} AS BIGINT) AS VARCHAR) ELSE CAST({column} AS VARCHAR) END",
        "t": f"strftime({column}, '%Y-%m-%dT%H:%M:%S.%f')",
        "s": f"CASE WHEN length({_trim(column)}) > 256 THEN 'md5:' || md5({_trim(column)}) || CASE WHEN length({_trim(column)}) < length({column}) THEN '+' || md5({column}) ELSE '' END ELSE {column} END",
    }[kind]


def _cells() -> str:
    out = []
    for table, columns in SOURCES.items():
        for k, c in enumerate(columns.split()):
            if c != "-":
                name, kind = c.split(":")
                out.append(f"SELECT '{table}' AS tbl, {k} AS ord, '{name}' AS col, '{KIND[kind]}' AS kind, {_text(name, kind)} AS value, count(*) AS n FROM {table} GROUP BY ALL")
    return "\nUNION ALL ".join(out)


NUMBER = r"'^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$'"
_G = "CASE WHEN {x} < 0 THEN '-' ELSE '' END || regexp_replace(CAST(CAST(floor(abs({x}) * pow(10.0, 5 - {p}) + 0.5) / pow(10.0, 5 - {p}) AS DECIMAL(24, 10)) AS VARCHAR), '\\.?0+$', '')"


def normalised(value: str) -> str:
    """A value in one form; numbers of under a million and over a ten-thousandth, as in the driver tables, need no exponent."""
    s = f"regexp_replace({_trim(value)}, '^(md5:[0-9a-f]{{32}})\\+[0-9a-f]{{32}}$', '\\1')"
    x = f"(CASE WHEN regexp_matches({s}, {NUMBER}) THEN TRY_CAST({s} AS DOUBLE) END)"
    g = _G.format(x=x, p=f"CAST(floor(log10(abs({x}))) AS INT)")
    return f"""CASE WHEN {s} = '' OR lower({s}) IN ('none', 'nan', 'null', 'na', 'nat') THEN NULL
      WHEN regexp_matches({s}, '^[+-]?\\d+(\\.0*)?$') THEN coalesce(nullif(ltrim(regexp_extract({s}, '^[+-]?(\\d+)', 1), '0'), ''), '0')
      WHEN {x} = floor({x}) AND abs({x}) < 1e18 THEN CAST(CAST({x} AS BIGINT) AS VARCHAR)
      WHEN {x} IS NOT NULL THEN {g} ELSE {s} END"""


def _domain(name: str) -> str:
    return "CASE " + " ".join(f"WHEN {_any_in(f'lower({name})', words)} THEN '{d}'" for d, words in W.DOMAIN_RULES.items()) + " ELSE 'other' END"


def _strip(name: str, endings) -> str:
    return "CASE " + " ".join(f"WHEN ends_with(lower({name}), '{e}') THEN left(lower({name}), length({name}) - {len(e)})" for e in endings) + f" ELSE lower({name}) END"


def cents(x: str) -> str:
    return f"(floor(({x}) * 100 + 0.5) / 100)"


_KNOWN = ", ".join(f"('{a}', {k}, '{f}')" for a, full in W.ABBREVIATIONS.items() for k, f in enumerate(full))
_ENDS = list(dict.fromkeys(e.lower() for e in W.REFERENCE_ENDINGS))
_END = ", ".join(f"({k}, '{e}')" for k, e in enumerate(_ENDS))
_ID = _any_in("lower(col)", W.ID_WORDS)
_SMALL = "coalesce(max{0} - min{0} > 0 AND max{0} - min{0} < 300 AND n{0} < 200 AND max{0} < 1000 AND n{0} / (max{0} - min{0}) > 0.3, false)"
_RUN = "coalesce(max{0} - min{0} > 0 AND n{0} >= 3 AND n{0} / (max{0} - min{0} + 1) > 0.85 AND min{0} >= 0 AND max{0} < 200, false)"
_SEG = "len(list_filter(string_split(lower(tbl_{1}), '_'), lambda s: length(s) >= 3 AND contains(lower(col_{0}), s))) > 0"

CHAIN: list[tuple[str, str]] = [
    ("cells", _cells()),
    ("stats", "SELECT tbl, ord, col, any_value(kind) AS kind, count(value) AS uniq, coalesce(sum(n) FILTER (value IS NULL), 0)::BIGINT AS nulls, sum(n)::BIGINT AS total FROM cells GROUP BY tbl, ord, col HAVING count(value) > 0"),
    ("ranked", "SELECT *, row_number() OVER (PARTITION BY tbl, col ORDER BY value) AS rank FROM cells WHERE value IS NOT NULL"),
    ("text_types", f"""SELECT tbl, col, count(*) AS n, count(x) AS parsed, count(*) FILTER (x = floor(x)) AS whole FROM (
       SELECT tbl, col, CASE WHEN regexp_matches(value, {NUMBER}) THEN TRY_CAST(value AS DOUBLE) END AS x FROM ranked WHERE kind = 'str') GROUP BY tbl, col"""),
    ("float_types", "SELECT tbl, col, bool_and(CAST(value AS DOUBLE) = floor(CAST(value AS DOUBLE))) AS whole FROM cells WHERE kind = 'float' AND value IS NOT NULL GROUP BY tbl, col"),
    ("typed", """SELECT s.*, CASE WHEN kind = 'float' THEN CASE WHEN f.whole THEN 'int' ELSE 'float' END WHEN kind <> 'str' THEN kind
       WHEN parsed > 0.8 * t.n THEN CASE WHEN t.whole = t.n THEN 'int' ELSE 'float' END ELSE 'str' END AS dtype
       FROM stats s LEFT JOIN text_types t USING (tbl, col) LEFT JOIN float_types f USING (tbl, col)"""),
    ("key_scores", f"""SELECT tbl, ord, col, uniq / total AS ratio,
       CASE WHEN lower(col) IN {_list(k.lower() for k in W.KEY_NAMES)} THEN 10 WHEN {' OR '.join(f"ends_with(lower(col), '{e}')" for e in W.KEY_ENDINGS)} THEN 5 ELSE 0 END AS name_score,
       CASE WHEN uniq / total >= 0.99 THEN 10 WHEN uniq / total >= 0.95 THEN 7 WHEN uniq / total >= 0.8 THEN 3 ELSE 0 END + CASE WHEN dtype = 'int' THEN 3 ELSE 1 END AS rest FROM typed"""),
    ("keys", """SELECT tbl, coalesce(
       (SELECT col FROM key_scores k WHERE k.tbl = t.tbl AND ratio >= 0.8 AND (name_score > 0 OR ratio >= 0.95) ORDER BY name_score + rest DESC, ord LIMIT 1),
       (SELECT CASE WHEN ratio >= 0.8 THEN col END FROM key_scores k WHERE k.tbl = t.tbl ORDER BY ord LIMIT 1)) AS pk FROM (SELECT DISTINCT tbl FROM typed) t"""),
    ("cols", """SELECT y.*, coalesce(pk = col, false) AS is_pk,
       regexp_matches(col, '^(\\w+?)(?:_id|_key|_no|_code|id|key|no|code)$', 'i') OR (contains(lower(col), '_id') AND dtype IN ('int', 'float')) OR (dtype = 'int' AND uniq / total > 0.1 AND uniq / total < 0.95) AS is_fk,
       uniq BETWEEN 2 AND 50 AND uniq / total <= 0.05 AS is_enum FROM typed y JOIN keys USING (tbl)"""),
    ("tabs", f"SELECT tbl, max(total) AS row_count, count(*) AS col_count, max(CASE WHEN is_pk THEN col END) AS pk, {_domain('tbl')} AS domain FROM cols GROUP BY tbl"),
    ("norm", f"""SELECT DISTINCT tbl, col, v AS value FROM (SELECT tbl, col, {normalised('value')} AS v FROM cells WHERE value IS NOT NULL
       AND NOT ({' OR '.join(f"ends_with(lower(col), '{e}')" for e in W.COMPOUND_ENDINGS)})) WHERE v IS NOT NULL"""),
    ("sized", f"SELECT tbl, col, count(*) AS n, min(x) AS lo, max(x) AS hi FROM (SELECT tbl, col, CASE WHEN regexp_matches(value, {NUMBER}) THEN TRY_CAST(value AS DOUBLE) END AS x FROM norm) GROUP BY tbl, col"),
    ("cand", f"""SELECT * FROM (SELECT tbl, col, dtype, total AS row_count, n, lo, hi, {_ID} AS idlike, is_pk, n / uniq AS ratio,
       CASE WHEN {_ID} THEN 3 ELSE 0 END + CASE WHEN n / uniq >= 0.95 THEN 2 WHEN n / uniq >= 0.8 THEN 1 ELSE 0 END AS priority,
       row_number() OVER (PARTITION BY tbl ORDER BY CASE WHEN {_ID} THEN 3 ELSE 0 END + CASE WHEN n / uniq >= 0.95 THEN 2 WHEN n / uniq >= 0.8 THEN 1 ELSE 0 END DESC, n / uniq DESC, ord) AS r
       FROM cols JOIN sized USING (tbl, col) WHERE uniq >= 3 AND n >= 3 AND ({_ID} OR NOT {_any_in('lower(col)', W.NOISE_WORDS)}) AND ({_ID} OR n / uniq BETWEEN 0.3 AND 1.0)) WHERE r <= 80"""),
    ("held", "SELECT n.* FROM norm n SEMI JOIN cand c ON n.tbl = c.tbl AND n.col = c.col"),
    ("wide", "SELECT value, count(*) AS k FROM held GROUP BY value"),
    ("pairs", """SELECT a.tbl AS tbl_a, a.col AS col_a, b.tbl AS tbl_b, b.col AS col_b, count(*) AS shared, count(*) FILTER (k <= 200) AS gated
       FROM held a JOIN held b USING (value) JOIN wide USING (value) WHERE a.tbl < b.tbl GROUP BY ALL HAVING count(*) FILTER (k <= 200) > 0"""),
    ("scored", f"""SELECT *, CASE WHEN shared / na >= thr AND na <= nb * 0.95 THEN 'a_to_b' WHEN shared / nb >= thr AND nb <= na * 0.95 THEN 'b_to_a' WHEN j >= 0.8 THEN 'unknown' END AS direction,
       CASE WHEN shared / na >= thr AND na <= nb * 0.95 THEN shared / na * 0.7 + j * 0.2 + na / nb * 0.1 + bonus
            WHEN shared / nb >= thr AND nb <= na * 0.95 THEN shared / nb * 0.7 + j * 0.2 + nb / na * 0.1 + bonus WHEN j >= 0.8 THEN j * 0.8 + bonus END AS score
       FROM (SELECT p.*, a.dtype AS dta, b.dtype AS dtb, a.row_count AS rowsa, b.row_count AS rowsb, a.n AS na, b.n AS nb, a.lo AS mina, a.hi AS maxa, b.lo AS minb, b.hi AS maxb,
         a.idlike AS ida, b.idlike AS idb, a.is_pk AS pka, b.is_pk AS pkb, shared / (a.n + b.n - shared) AS j, CASE WHEN a.idlike AND b.idlike THEN 0.05::DOUBLE ELSE 0.0::DOUBLE END AS bonus,
         CASE WHEN (a.idlike AND b.is_pk) OR (b.idlike AND a.is_pk) THEN 0.7::DOUBLE ELSE 0.8::DOUBLE END AS thr
         FROM pairs p JOIN cand a ON p.tbl_a = a.tbl AND p.col_a = a.col JOIN cand b ON p.tbl_b = b.tbl AND p.col_b = b.col
         WHERE gated >= CASE WHEN a.idlike OR b.idlike THEN 3 ELSE 5 END AND shared >= 3)"""),
    ("matched", f"""SELECT *, {_SEG.format('a', 'b')} OR {_SEG.format('b', 'a')} AS named, {_SMALL.format('a')} AND {_SMALL.format('b')} AS small, {_RUN.format('a')} OR {_RUN.format('b')} AS run,
       pka AND na < 50 AS ska, pkb AND nb < 50 AS skb FROM scored WHERE direction IS NOT NULL"""),
    ("adj1", "SELECT *, CASE WHEN dta = dtb THEN score + 0.05::DOUBLE WHEN NOT (dta IN ('int', 'float') AND dtb IN ('int', 'float')) AND NOT ida AND NOT idb THEN score - 0.15::DOUBLE ELSE score END AS c1 FROM matched"),
    ("adj2", "SELECT *, CASE WHEN NOT small THEN c1 WHEN named THEN c1 - 0.1::DOUBLE WHEN maxa - mina < 50 AND maxb - minb < 50 THEN c1 * 0.3::DOUBLE ELSE c1 * 0.5::DOUBLE END AS c2 FROM adj1"),
    ("adj3", f"SELECT *, CASE WHEN run AND NOT named THEN c2 * 0.6::DOUBLE ELSE c2 END * CASE WHEN lower(trim(col_a)) IN {_list(W.GENERIC_NAMES)} AND lower(trim(col_b)) IN {_list(W.GENERIC_NAMES)} THEN 0.8::DOUBLE ELSE 1.0::DOUBLE END AS c3 FROM adj2"),
    ("adj4", "SELECT *, CASE WHEN ska AND skb THEN c3 * 0.25::DOUBLE WHEN (ska OR skb) AND NOT named THEN c3 * CASE WHEN CASE WHEN ska THEN na ELSE nb END < 30 THEN 0.4::DOUBLE ELSE 0.6::DOUBLE END ELSE c3 END AS c4 FROM adj3"),
    ("adjusted", f"SELECT * FROM (SELECT *, {cents('greatest(0.05::DOUBLE, CASE WHEN named THEN least(c4 + 0.1::DOUBLE, score + 0.05::DOUBLE) ELSE c4 END)')} AS confidence FROM adj4) WHERE confidence >= 0.3"),
    ("contained", """SELECT CASE WHEN fwd THEN tbl_a ELSE tbl_b END AS from_table, CASE WHEN fwd THEN col_a ELSE col_b END AS from_column, CASE WHEN fwd THEN tbl_b ELSE tbl_a END AS to_table,
       CASE WHEN fwd THEN col_b ELSE col_a END AS to_column, CASE WHEN direction = 'unknown' THEN 'fk_content_overlap' ELSE 'fk_content_subset' END AS relation_type, confidence, 'containment' AS discovery_method,
       'shared(' || shared || ')' AS evidence FROM (SELECT *, CASE WHEN direction = 'a_to_b' THEN true WHEN direction = 'b_to_a' THEN false
         WHEN na >= rowsa * 0.95 AND nb < rowsb * 0.95 THEN false WHEN nb >= rowsb * 0.95 AND na < rowsa * 0.95 THEN true WHEN rowsa > rowsb * 1.2 THEN false WHEN rowsb > rowsa * 1.2 THEN true END AS fwd FROM adjusted) WHERE fwd IS NOT NULL"""),
    ("known", f"SELECT * FROM (VALUES {_KNOWN}) AS v(abbreviation, place, full_name)"),
    ("ends", f"SELECT tbl, col, k, left(lower(col), length(col) - length(e)) AS prefix FROM cols, (VALUES {_END}) AS v(k, e) WHERE ends_with(lower(col), e) AND length(col) > length(e)"),
    ("asked", f"""SELECT tbl, col, k, 1 AS step, 0 AS place, prefix AS name FROM ends UNION ALL
       SELECT tbl, col, k, 2, place, full_name FROM ends JOIN known ON abbreviation = {_strip('col', W.LOOKUP_ENDINGS)} UNION ALL SELECT tbl, col, k, 2, 99, {_strip('col', W.LOOKUP_ENDINGS)} FROM ends UNION ALL
       SELECT tbl, col, k, 3, 2 * i, array_to_string(string_split(prefix, '_')[i:], '_') FROM ends, unnest(range(1, len(string_split(prefix, '_')) + 1)) AS u(i) WHERE length(array_to_string(string_split(prefix, '_')[i:], '_')) >= 2 UNION ALL
       SELECT tbl, col, k, 3, 2 * i + 1, string_split(prefix, '_')[i] FROM ends, unnest(range(1, len(string_split(prefix, '_')) + 1)) AS u(i) WHERE length(string_split(prefix, '_')[i]) >= 3"""),
    ("stems", "SELECT string_split(lower(tbl), '_')[1] AS stem, arg_min(tbl, (length(tbl), tbl)) AS target FROM tabs WHERE length(string_split(lower(tbl), '_')[1]) >= 3 GROUP BY 1"),
    ("refs", """SELECT tbl, col, arg_min(target, (k, step, place, target)) AS target FROM (
       SELECT a.tbl, a.col, k, step, place, t.tbl AS target FROM asked a JOIN tabs t ON lower(t.tbl) = a.name UNION ALL
       SELECT e.tbl, e.col, k, 4, 0, target FROM ends e JOIN stems ON string_split(prefix, '_')[-1] = stem WHERE lower(target) <> prefix) GROUP BY tbl, col"""),
    ("named_edges", "SELECT r.tbl AS f, r.col AS fc, r.target AS t, x.pk AS tc, a.dtype AS d1, b.dtype AS d2 FROM refs r JOIN tabs x ON x.tbl = r.target JOIN cols a ON a.tbl = r.tbl AND a.col = r.col JOIN cols b ON b.tbl = r.target AND b.col = x.pk WHERE r.tbl <> r.target"),
    ("named_share", "SELECT f, fc, t, tc, count(y.value) / count(*) AS share FROM named_edges e JOIN norm x ON x.tbl = f AND x.col = fc LEFT JOIN norm y ON y.tbl = t AND y.col = tc AND y.value = x.value GROUP BY ALL"),
    ("naming", f"""SELECT f AS from_table, fc AS from_column, t AS to_table, tc AS to_column, 'fk_naming_convention' AS relation_type,
       {cents("least(0.95::DOUBLE, greatest(0.1::DOUBLE, 0.7::DOUBLE + CASE WHEN d1 = d2 THEN 0.1::DOUBLE ELSE 0 END + CASE WHEN share >= 0.5 THEN 0.15::DOUBLE WHEN share >= 0.2 THEN 0.05::DOUBLE WHEN share = 0 THEN -0.2::DOUBLE ELSE 0 END))")} AS confidence,
       'naming_convention' AS discovery_method, 'name ' || fc AS evidence FROM named_edges LEFT JOIN named_share USING (f, fc, t, tc)"""),
    ("strong", "SELECT * FROM contained UNION ALL SELECT * FROM naming"),
    ("seeds", """SELECT abbreviation, arg_min(tbl, (place, h, length(tbl), tbl)) AS target FROM (SELECT abbreviation, place, tbl, CASE WHEN lower(tbl) = full_name THEN 0 ELSE 1 END AS h
       FROM known JOIN tabs ON lower(tbl) = full_name OR starts_with(lower(tbl), full_name || '_') WHERE length(abbreviation) BETWEEN 2 AND 5) GROUP BY 1"""),
    ("mined", f"""SELECT c AS abbreviation, to_table AS target, count(*) AS n FROM (SELECT {_strip('from_column', W.CLEAN_ENDINGS)} AS c, to_table FROM strong WHERE confidence >= 0.8)
       WHERE length(c) BETWEEN 2 AND 4 AND regexp_matches(lower(to_table), '^.*' || array_to_string(list_transform(string_split(c, ''), lambda x: regexp_escape(x)), '.*') || '.*$') GROUP BY 1, 2"""),
    ("patterns", f"SELECT coalesce(m.abbreviation, s.abbreviation) AS abbreviation, coalesce(m.target, s.target) AS target, {cents('CASE WHEN n IS NULL THEN 0.65::DOUBLE ELSE least(0.95::DOUBLE, CASE WHEN s.target IS NULL THEN 0.5::DOUBLE ELSE 0.65::DOUBLE END + 0.1::DOUBLE * n) END')} AS base FROM mined m FULL JOIN seeds s ON m.abbreviation = s.abbreviation AND m.target = s.target"),
    ("short_edges", f"""SELECT c.tbl AS f, c.col AS fc, p.target AS t, x.pk AS tc, p.abbreviation, p.base FROM cols c JOIN patterns p ON p.abbreviation = {_strip('c.col', W.CLEAN_ENDINGS)} JOIN tabs x ON x.tbl = p.target
       WHERE c.tbl <> p.target AND x.pk IS NOT NULL AND NOT EXISTS (SELECT 1 FROM strong s WHERE (s.from_table, s.from_column, s.to_table, s.to_column) IN ((c.tbl, c.col, p.target, x.pk), (p.target, x.pk, c.tbl, c.col)))"""),
    ("short_share", "SELECT f, fc, t, tc, abbreviation, base, count(y.value) / count(*) AS share FROM short_edges e JOIN norm x ON x.tbl = f AND x.col = fc LEFT JOIN norm y ON y.tbl = t AND y.col = tc AND y.value = x.value GROUP BY ALL"),
    ("abbreviated", f"SELECT f AS from_table, fc AS from_column, t AS to_table, tc AS to_column, 'fk_abbreviation' AS relation_type, {cents('base * 0.8::DOUBLE')} AS confidence, 'abbreviation' AS discovery_method, 'abbreviation ' || abbreviation AS evidence FROM short_share WHERE share >= 0.3"),
    ("direct", "SELECT * FROM strong UNION ALL SELECT * FROM abbreviated"),
    ("chains", f"""SELECT a.from_table, a.from_column, b.to_table, b.to_column, 'inferred_transitive' AS relation_type, {cents('a.confidence * b.confidence * 0.5::DOUBLE')} AS confidence, 'transitive' AS discovery_method,
       a.from_table || '.' || a.from_column || '->' || a.to_table || '.' || a.to_column || '->' || b.to_table || '.' || b.to_column AS evidence
       FROM direct a JOIN direct b ON a.to_table = b.from_table WHERE a.confidence >= 0.65 AND b.confidence >= 0.65 AND a.from_table <> b.to_table
       AND NOT EXISTS (SELECT 1 FROM direct d WHERE (d.from_table = a.from_table AND d.to_table = b.to_table) OR (d.from_table = b.to_table AND d.to_table = a.from_table))"""),
    ("transitive", "SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY from_table, to_table ORDER BY confidence DESC, evidence) AS r FROM chains) WHERE r = 1 ORDER BY confidence DESC, evidence LIMIT 500"),
    ("every", "SELECT * FROM direct UNION ALL SELECT * EXCLUDE (r) FROM transitive"),
    ("ended", "SELECT *, least(from_table || '.' || from_column, to_table || '.' || to_column) AS k1, greatest(from_table || '.' || from_column, to_table || '.' || to_column) AS k2 FROM every"),
    ("best", "SELECT *, row_number() OVER (PARTITION BY k1, k2 ORDER BY confidence DESC, from_table DESC, from_column DESC, to_table DESC, to_column DESC, relation_type DESC, discovery_method DESC) AS r FROM ended"),
    ("doubts", "SELECT k1, k2, count(DISTINCT discovery_method) AS methods, product(1 - confidence) AS doubt FROM ended GROUP BY k1, k2"),
    ("fused", f"SELECT * EXCLUDE (confidence, r, methods, doubt), CASE WHEN methods > 1 THEN {cents('least(0.98::DOUBLE, 1 - doubt)')} ELSE confidence END AS confidence FROM best JOIN doubts USING (k1, k2) WHERE r = 1"),
    ("deduped", """SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY least(from_table, to_table), greatest(from_table, to_table)
       ORDER BY CASE discovery_method WHEN 'naming_convention' THEN 3 WHEN 'abbreviation' THEN 2 WHEN 'containment' THEN 1 ELSE 0 END DESC, confidence DESC, from_table, from_column, to_table, to_column) AS r FROM fused) WHERE r <= 2"""),
    ("relations", "SELECT * FROM deduped WHERE confidence >= 0.5"),
    ("seen", """SELECT from_table AS tbl, 'out' AS direction, to_table AS neighbour, from_table || '.' || from_column || ' = ' || to_table || '.' || to_column AS join_text, confidence FROM relations UNION ALL
       SELECT to_table, 'in', from_table, from_table || '.' || from_column || ' = ' || to_table || '.' || to_column, confidence FROM relations"""),
    ("undirected", """SELECT x, y, confidence AS c, step FROM (SELECT *, row_number() OVER (PARTITION BY x, y ORDER BY confidence DESC, step) AS r FROM (
       SELECT from_table AS x, to_table AS y, confidence, from_table || '.' || from_column || '=' || to_table || '.' || to_column AS step FROM relations UNION ALL
       SELECT to_table, from_table, confidence, from_table || '.' || from_column || '=' || to_table || '.' || to_column FROM relations) WHERE x <> y) WHERE r = 1"""),
]
NAMES = [n for n, _ in CHAIN]
BODY = dict(CHAIN)


def _needed(sql: str) -> list[str]:
    """The common tables that a statement needs, in order."""
    import re

    wanted, todo = set(), [sql]
    while todo:
        words = set(re.findall(r"\w+", todo.pop()))
        for n in NAMES:
            if n in words and n not in wanted:
                wanted.add(n)
                todo.append(BODY[n])
    return [n for n in NAMES if n in wanted]


#: Bodies under the settings of ``strict_relations``.
STRICT = BODY | {"chains": BODY["chains"].replace("0.65", "0.8"), "deduped": BODY["deduped"].replace("r <= 2", "r <= 1"), "relations": BODY["relations"].replace("0.5", "0.7")}


def chained(select: str, extra: str = "", strict: bool = False) -> str:
    body = STRICT if strict else BODY
    parts = [f"{n} AS MATERIALIZED ({body[n]})" for n in _needed(select + " " + extra)]
    recursive = "RECURSIVE " if extra else ""
    return f"WITH {recursive}" + ",\n".join(parts + ([extra] if extra else [])) + "\n" + select


EDGE = "from_table, from_column, to_table, to_column, relation_type, confidence, discovery_method"


def _walks(hops: int, least: float, where: str = "true") -> str:
    return f"""walks(src, dst, confidence, path, seen, hops) AS (SELECT x, y, c, step, [x, y], 1 FROM undirected WHERE c >= {least} AND {where}
      UNION ALL SELECT src, y, confidence * c, path || ' AND ' || step, list_append(seen, y), hops + 1 FROM walks JOIN undirected ON dst = x WHERE c >= {least} AND hops < {hops} AND NOT list_contains(seen, y))"""


_SHORTEST = "SELECT src, dst, hops::BIGINT AS hops, path FROM (SELECT *, row_number() OVER (PARTITION BY src, dst ORDER BY hops, confidence DESC, path) AS r FROM walks) WHERE r = 1"

_WORDS = "words(source, word, n_texts) AS (SELECT source, word, count(*) FROM (SELECT source, unnest(list_distinct(list_transform(regexp_extract_all(t, '[A-Za-z_]+'), lambda x: lower(x)))) AS word FROM (" + " UNION ALL ".join(
    f"SELECT '{t}' AS source, {x} AS t FROM {t}" for t, x in (("documents", "text"), ("conversations", "text"), ("pages", "html"), ("part", "p_name"))
) + " UNION ALL SELECT 'columns', col FROM cols)) GROUP BY 1, 2)"
_LABELS = _WORDS + ", entities(entity, place, name) AS (VALUES " + ", ".join(f"('{e}', {k}, '{n}')" for e, names in W.ENTITIES.items() for k, n in enumerate(names)) + """),
  labels(source, "column") AS (SELECT DISTINCT source, entity || '编号' FROM words JOIN entities ON word = name)"""

ORACLES: dict[str, str] = {
    "column_stats": chained('SELECT tbl AS "table", col AS "column", uniq AS unique_count, nulls AS null_count, total AS total_count FROM stats'),
    "column_samples": chained('SELECT tbl AS "table", col AS "column", value, rank FROM ranked WHERE rank <= 20'),
    "column_dtypes": chained('SELECT tbl AS "table", col AS "column", dtype FROM typed'),
    "primary_keys": chained('SELECT tbl AS "table", pk AS primary_key FROM keys'),
    "fk_candidates": chained('SELECT tbl AS "table", col AS "column" FROM cols WHERE is_fk'),
    "enum_columns": chained('SELECT tbl AS "table", col AS "column", uniq AS unique_count FROM cols WHERE is_enum'),
    "numeric_columns": chained("SELECT tbl AS \"table\", col AS \"column\" FROM cols WHERE dtype IN ('int', 'float')"),
    "table_profile": chained('SELECT tbl AS "table", row_count, col_count, pk AS primary_key, domain FROM tabs'),
    "domain_labels": chained('SELECT tbl AS "table", domain FROM tabs'),
    "domain_best_match": chained(
        "SELECT tbl AS \"table\", (SELECT d FROM (VALUES "
        + ", ".join(f"({k}, '{d}', '{w}')" for k, (d, ws) in enumerate(W.DOMAIN_WORDS.items()) for w in ws)
        + ") AS v(k, d, w) WHERE contains(lower(tbl), w) ORDER BY length(w) DESC, k LIMIT 1) AS domain FROM tabs"
    ),
    "graph_stats": chained("SELECT (SELECT count(DISTINCT tbl) FROM cols) AS n_tables, (SELECT count(*) FROM cols) AS n_columns, (SELECT count(*) FROM relations) AS n_relations"),
    "header_rows": """WITH rows AS (SELECT 'document:' || doc_id AS source, i - 1 AS k, string_split(lines[i], ' ') AS cells FROM (SELECT doc_id, string_split(text, chr(10)) AS lines FROM documents), range(1, 6) AS r(i) WHERE i <= len(lines)
        UNION ALL SELECT 'conversation:' || conv_id, turn, string_split(text, ' ') FROM conversations WHERE turn < 5),
      filled AS (SELECT source, k, list_filter(list_transform(cells, lambda x: trim(x)), lambda x: x <> '') AS f FROM rows WHERE cells IS NOT NULL),
      kinds AS (SELECT source, k, CASE WHEN len(f) = 0 THEN 'blank' WHEN len(list_filter(f, lambda x: list_contains([""" + ", ".join(f"'{w}'" for w in W.TYPE_WORDS) + """], lower(x)))) / len(f) > 0.7 THEN 'meta'
        WHEN len(list_filter(f, lambda x: regexp_full_match(x, '[A-Za-z_][A-Za-z0-9_]*'))) / len(f) > 0.8 THEN 'meta' WHEN len(list_filter(f, lambda x: try_cast(x AS DOUBLE) IS NOT NULL)) / len(f) < 0.1 THEN 'text' ELSE 'data' END AS kind FROM filled),
      told AS (SELECT source, k, row_number() OVER w - 1 AS place, kind IN ('meta', 'blank') OR (kind = 'text' AND coalesce(bool_or(kind = 'meta') OVER (PARTITION BY source ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), false)) AS header FROM kinds WINDOW w AS (PARTITION BY source ORDER BY k))
      SELECT source, coalesce(min(place) FILTER (NOT header), count(*))::BIGINT AS header_rows FROM told GROUP BY 1""",
    "schema_diff": chained("""SELECT 'part' AS "table", 'p_size' AS "column", 'added' AS change FROM cols WHERE col = 'p_size' UNION ALL SELECT 'nation', 'n_comment', 'removed'
      UNION ALL SELECT tbl, col, 'type_changed' FROM cols WHERE col = 'o_totalprice' AND dtype <> 'str'"""),
    "normalized_values": chained('SELECT tbl AS "table", col AS "column", count(*) AS n_values, min(value) AS first_value, max(value) AS last_value FROM norm GROUP BY 1, 2'),
    "compound_values": """WITH listed AS (SELECT o_custkey, string_agg(o_orderkey::VARCHAR, ',' ORDER BY o_orderkey) AS ids FROM orders GROUP BY o_custkey),
      forms AS (SELECT CASE WHEN o_custkey % 3 = 0 THEN replace(ids, ',', '|') || '||' ELSE replace(ids, ',', ';') END AS v FROM listed),
      members AS (SELECT CASE WHEN ends_with(v, '|') THEN [v] ELSE string_split(v, ';') END AS m FROM forms)
      SELECT DISTINCT w AS value, length(w) AS n_chars FROM (SELECT CASE WHEN length(x) > 256 THEN 'md5:' || md5(x) ELSE x END AS w FROM (SELECT unnest(m) AS x FROM members))""",
    "expand_column_names": chained(
        f"""SELECT DISTINCT "column", expansion FROM (SELECT c AS "column", {_strip('c', W.LOOKUP_ENDINGS)} AS expansion FROM (SELECT DISTINCT col AS c FROM cols UNION SELECT unnest(['sid', 'tid_id', 'mid']))
        UNION ALL SELECT c, full_name FROM (SELECT DISTINCT col AS c FROM cols UNION SELECT unnest(['sid', 'tid_id', 'mid'])) JOIN known ON abbreviation = {_strip('c', W.LOOKUP_ENDINGS)})"""
    ),
    "abbrev_lookup": chained("SELECT source, word, place::BIGINT AS place, full_name, n_texts FROM words JOIN known ON abbreviation = word", _WORDS),
    "full_name_lookup": chained("SELECT source, word, string_agg(DISTINCT abbreviation, ',' ORDER BY abbreviation) AS abbreviations, n_texts FROM words JOIN known ON full_name = word GROUP BY 1, 2, 4", _WORDS),
    "clean_columns": chained(f'SELECT tbl AS "table", col AS "column", {_strip("col", W.CLEAN_ENDINGS)} AS clean FROM cols'),
    "subsequence_match": chained("""SELECT DISTINCT col AS "column", t.tbl AS "table" FROM cols c, tabs t
      WHERE regexp_matches(t.tbl, '^.*' || array_to_string(list_transform(string_split(left(col, 4), ''), lambda x: regexp_escape(x)), '.*') || '.*$')"""),
    "excel_letters": """WITH RECURSIVE sheets AS (SELECT doc_id, list_max(list_transform(string_split(text, chr(10)), lambda x: len(string_split(x, ' ')))) AS n_columns FROM documents),
      named(doc_id, n_columns, n, letters) AS (SELECT doc_id, n_columns, n_columns, '' FROM sheets UNION ALL SELECT doc_id, n_columns, (n - 1) // 26, chr((65 + (n - 1) % 26)::INT) || letters FROM named WHERE n > 0)
      SELECT doc_id, n_columns, CASE WHEN n_columns IS NOT NULL THEN letters END AS last_letter FROM named WHERE coalesce(n, 0) = 0""",
    "candidate_columns": chained('SELECT tbl AS "table", col AS "column", dtype, row_count, n AS unique_values, idlike AS is_id_like, is_pk, priority::BIGINT AS priority FROM cand'),
    "value_inverted_index": chained("SELECT value, k AS n_columns FROM wide"),
    "column_pair_overlap": chained("SELECT tbl_a AS table_a, col_a AS column_a, tbl_b AS table_b, col_b AS column_b, shared, gated FROM pairs"),
    "incremental_pairs": chained("SELECT tbl_a AS table_a, col_a AS column_a, tbl_b AS table_b, col_b AS column_b, shared FROM pairs WHERE tbl_a IN ('orders', 'events') OR tbl_b IN ('orders', 'events')"),
    "containment_scores": chained(f"SELECT tbl_a AS table_a, col_a AS column_a, tbl_b AS table_b, col_b AS column_b, direction, CASE WHEN direction = 'unknown' THEN 'fk_content_overlap' ELSE 'fk_content_subset' END AS match_type, {cents('score')} AS score FROM scored WHERE direction IS NOT NULL"),
    "confidence_adjust": chained("SELECT tbl_a AS table_a, col_a AS column_a, tbl_b AS table_b, col_b AS column_b, confidence FROM adjusted"),
    "containment_relations": chained(f"SELECT {EDGE} FROM contained"),
    "relation_evidence": chained("""SELECT from_table, from_column, to_table, to_column, count(*) AS shared, array_to_string(list_sort(list(a.value))[:5], ',') AS examples
      FROM (SELECT DISTINCT from_table, from_column, to_table, to_column FROM relations) JOIN norm a ON a.tbl = from_table AND a.col = from_column JOIN norm b ON b.tbl = to_table AND b.col = to_column AND a.value = b.value GROUP BY 1, 2, 3, 4"""),
    "naming_relations": chained(f"SELECT {EDGE} FROM naming"),
    "abbrev_mining": chained("SELECT abbreviation, target AS to_table, base AS confidence FROM patterns"),
    "abbrev_relations": chained(f"SELECT {EDGE} FROM abbreviated"),
    "column_index_cn": chained("""SELECT e.entity AS segment, string_agg(DISTINCT source, ',' ORDER BY source) AS tables FROM labels, (SELECT DISTINCT entity FROM entities) e
      WHERE contains(regexp_replace("column", '[^\u4e00-\u9fff]', '', 'g'), e.entity) GROUP BY 1""", _LABELS),
    "cn_bridge": chained(f"""SELECT "column", tbl AS to_table FROM (SELECT DISTINCT "column" FROM labels) JOIN (
        SELECT entity, word AS tbl, place, CASE WHEN word = name THEN 0 WHEN {_strip('word', W.STEM_ENDINGS)} = name THEN 1 WHEN starts_with(word, name || '_') THEN 2 END AS how
        FROM (SELECT DISTINCT word FROM words), entities WHERE starts_with(word, name)) ON how IS NOT NULL AND contains("column", entity)
      QUALIFY row_number() OVER (PARTITION BY "column" ORDER BY strpos(reverse("column"), reverse(entity)), length(entity) DESC, place, how, length(tbl), tbl) = 1""", _LABELS),
    "transitive_relations": chained(f"SELECT {EDGE}, evidence FROM transitive"),
    "feedback_apply": chained(f"""SELECT from_table, from_column, to_table, to_column, relation_type, CASE WHEN (from_column = 'c_nationkey' AND to_column = 'n_nationkey') OR (from_column = 'n_nationkey' AND to_column = 'c_nationkey') THEN 1.0::DOUBLE ELSE confidence END AS confidence, discovery_method
      FROM direct WHERE NOT (from_column = 'n_regionkey' AND to_column = 'r_regionkey') AND NOT (from_column = 'r_regionkey' AND to_column = 'n_regionkey')"""),
    "fuse_relations": chained(f"SELECT {EDGE} FROM fused"),
    "dedupe_relations": chained(f"SELECT {EDGE} FROM deduped"),
    "final_relations": chained(f"SELECT {EDGE} FROM relations"),
    "strict_relations": chained(f"SELECT {EDGE} FROM relations", strict=True),
    "enhanced_relations": chained(f"SELECT {EDGE} FROM kept_pairs WHERE r = 1 AND confidence >= 0.5", """again AS (SELECT from_table, from_column, to_table, to_column, relation_type, confidence, discovery_method FROM relations
        UNION ALL SELECT from_table, from_column, to_table, to_column, relation_type, confidence, discovery_method FROM every),
      once AS (SELECT * FROM again QUALIFY row_number() OVER (PARTITION BY least(from_table || '.' || from_column, to_table || '.' || to_column), greatest(from_table || '.' || from_column, to_table || '.' || to_column)
        ORDER BY confidence DESC, from_table, from_column, to_table, to_column) = 1),
      kept_pairs AS (SELECT *, CASE WHEN row_number() OVER (PARTITION BY least(from_table, to_table), greatest(from_table, to_table) ORDER BY CASE discovery_method WHEN 'naming_convention' THEN 3 WHEN 'abbreviation' THEN 2
        WHEN 'containment' THEN 1 ELSE 0 END DESC, confidence DESC, from_table, from_column, to_table, to_column) <= 2 THEN 1 END AS r FROM once)"""),
    "orphans": chained('SELECT tbl AS "table" FROM tabs WHERE tbl NOT IN (SELECT tbl FROM seen)'),
    "table_degree": chained('SELECT t.tbl AS "table", count(s.tbl) AS degree FROM tabs t LEFT JOIN seen s ON s.tbl = t.tbl GROUP BY 1'),
    "join_paths": chained(_SHORTEST, _walks(2, 0.65)),
    "find_join_path": chained(_SHORTEST, _walks(3, 0.6, "x = 'lineitem'")),
    "report_paths": chained(f"SELECT * FROM ({_SHORTEST}) WHERE src = 'customer' ORDER BY hops, path LIMIT 5", _walks(3, 0.0, "x = 'customer'")),
    "report_path_search": chained(
        "SELECT src, dst, hops::BIGINT AS hops, path FROM (SELECT *, row_number() OVER (PARTITION BY src, dst ORDER BY hops, confidence DESC, path) AS r FROM walks WHERE contains(dst, 'n')) WHERE r = 1 ORDER BY hops, src, dst LIMIT 5",
        _walks(3, 0.0, "contains(x, 'er')").replace("FROM walks JOIN undirected ON dst = x WHERE", "FROM walks JOIN undirected ON dst = x WHERE NOT contains(dst, 'n') AND"),
    ),
    "report_dag": chained(
        "SELECT from_table, to_table, confidence FROM surest b WHERE NOT EXISTS (SELECT 1 FROM led WHERE led.k = b.k AND led.place = b.from_table)",
        """surest(from_table, to_table, confidence, k) AS (SELECT from_table, to_table, confidence, row_number() OVER (ORDER BY confidence DESC, from_table, to_table) FROM (
             SELECT from_table, to_table, confidence, row_number() OVER (PARTITION BY least(from_table, to_table), greatest(from_table, to_table) ORDER BY confidence DESC, from_table) AS r
             FROM relations WHERE confidence >= 0.5 AND from_table <> to_table) WHERE r = 1),
           led(k, place) AS (SELECT k, to_table FROM surest UNION SELECT led.k, e.to_table FROM led JOIN surest e ON e.from_table = led.place AND e.k < led.k)""",
    ),
    "cycles": chained(
        "SELECT array_to_string(seen, '>') AS cycle, len(seen)::BIGINT AS n_tables FROM tours JOIN (SELECT DISTINCT from_table AS x, to_table AS y FROM relations) e ON e.x = last AND e.y = first",
        """tours(first, last, seen) AS (SELECT DISTINCT from_table, to_table, [from_table, to_table] FROM relations WHERE from_table < to_table UNION ALL
           SELECT first, y, list_append(seen, y) FROM tours JOIN (SELECT DISTINCT from_table AS x, to_table AS y FROM relations) ON x = last WHERE len(seen) < 4 AND y > first AND NOT list_contains(seen, y))""",
    ),
    "schema_summary": chained("SELECT domain, count(*) AS n_tables, string_agg(tbl, ',' ORDER BY tbl) AS tables FROM tabs GROUP BY 1"),
    "column_index": chained(f"""SELECT kind, name, string_agg(DISTINCT tbl, ',' ORDER BY tbl) AS tables FROM (SELECT 'exact' AS kind, col AS name, tbl FROM cols UNION ALL
      SELECT 'normalized', {_strip('col', W.INDEX_ENDINGS)}, tbl FROM cols WHERE {_strip('col', W.INDEX_ENDINGS)} <> lower(col)) GROUP BY 1, 2"""),
    "relation_graph": chained('SELECT tbl AS "table", direction, neighbour, join_text, confidence FROM seen WHERE confidence >= 0.5'),
    "value_index": chained("""SELECT value, count(DISTINCT tbl) AS n_tables, count(*) AS n_locations, string_agg(DISTINCT tbl || '.' || col, ',' ORDER BY tbl || '.' || col) AS locations
      FROM cells JOIN (SELECT tbl, col FROM cols WHERE is_fk OR is_enum) USING (tbl, col) WHERE value IS NOT NULL GROUP BY value HAVING count(DISTINCT tbl) >= 2 ORDER BY n_locations DESC, value LIMIT 5000"""),
    "domain_graph": chained(f"""SELECT least(a.domain, b.domain) AS domain_a, greatest(a.domain, b.domain) AS domain_b, count(*) AS n_relations, {cents('sum(floor(confidence * 100 + 0.5)) / count(*) / 100')} AS avg_confidence, max(confidence) AS max_confidence
      FROM relations JOIN tabs a ON a.tbl = from_table JOIN tabs b ON b.tbl = to_table WHERE a.domain <> b.domain AND confidence >= 0.5 GROUP BY 1, 2"""),
    "enum_cross_ref": chained("""SELECT "column", tables, count(*) FILTER (k = n) AS shared, count(*) AS total, coalesce(array_to_string(list_sort(list(value) FILTER (k = n))[:20], ','), '') AS shared_values FROM (
      SELECT col AS "column", value, count(DISTINCT tbl) AS k FROM cells JOIN (SELECT tbl, col FROM cols WHERE is_enum) USING (tbl, col) WHERE value IS NOT NULL GROUP BY 1, 2)
      JOIN (SELECT col AS "column", count(*) AS n, string_agg(tbl, ',' ORDER BY tbl) AS tables FROM cols WHERE is_enum GROUP BY 1 HAVING count(*) >= 2) USING ("column")
      GROUP BY 1, 2 HAVING count(*) FILTER (k = n) >= 2 AND 2 * count(*) FILTER (k = n) >= count(*)"""),
    "cell_locator": chained("SELECT tbl AS \"table\", col AS \"column\", ord::BIGINT AS column_index, chr((65 + ord)::INT) AS letter, 2::BIGINT AS data_start_row FROM cols"),
    "table_description": chained(
        "SELECT tbl AS \"table\", tbl || ': ' || CASE domain "
        + " ".join(f"WHEN '{d}' THEN '{n[0]}'" for d, n in W.DOMAIN_NAMES.items())
        + " ELSE '其他' END || ', ' || CASE WHEN row_count < 200 THEN '小型' WHEN row_count < 2000 THEN '中型' ELSE '大型' END || ', ' || row_count || ' 行, ' || col_count || ' 列' || coalesce(', 主键 ' || pk, '') AS description FROM tabs"
    ),
    "query_table": chained("SELECT tbl AS \"table\", direction, neighbour, join_text, confidence FROM seen WHERE contains(tbl, 'item')"),
    "query_columns": chained("""SELECT tbl AS "table", domain, row_count, col_count, pk AS primary_key, first_columns FROM tabs
      JOIN (SELECT tbl, array_to_string(list(col ORDER BY ord)[:5], ', ') AS first_columns FROM cols GROUP BY 1) USING (tbl) WHERE contains(tbl, 'e')"""),
    "table_relations": chained("SELECT from_table, from_column, to_table, to_column, confidence FROM relations WHERE from_table = 'orders' OR to_table = 'orders'"),
    "find_by_column": chained("""SELECT tbl AS "table", col AS "column", n AS n_grams FROM (SELECT tbl, col, (SELECT count(DISTINCT g) FROM (
      SELECT substr('nationkey', i::INT, l::INT) AS g FROM unnest([2, 3, 4]) AS a(l), range(1, 10) AS b(i) WHERE i + l <= 10) WHERE contains(lower(col), g)) AS n FROM cols) WHERE n > 0"""),
    "vector_topk": """SELECT vec_id, floor(list_sum(list_transform(list_zip(e, p), lambda z: z[1] * z[2])) / (sqrt(list_sum(list_transform(e, lambda x: x * x))) * sqrt(list_sum(list_transform(p, lambda x: x * x)))) * 1000000 + 0.5) / 1000000 AS similarity
      FROM (SELECT vec_id, list_transform(embedding, lambda x: x::DOUBLE) AS e, list_transform(range(len(embedding)), lambda k: CASE WHEN k % 2 = 1 THEN 1.0::DOUBLE ELSE -0.5::DOUBLE END) AS p FROM embeddings) ORDER BY similarity DESC, vec_id LIMIT 10""",
    "vector_neighbours": """WITH e AS (SELECT vec_id, list_transform(embedding, lambda x: x::DOUBLE) AS e FROM embeddings), s AS (SELECT q.vec_id AS query, v.vec_id,
        floor(list_sum(list_transform(list_zip(v.e, q.e), lambda z: z[1] * z[2])) / (sqrt(list_sum(list_transform(v.e, lambda x: x * x))) * sqrt(list_sum(list_transform(q.e, lambda x: x * x)))) * 1000000 + 0.5) / 1000000 AS similarity
      FROM e AS q, e AS v WHERE q.vec_id % 100 = 0) SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY query ORDER BY similarity DESC, vec_id) <= 10""",
    "recall_tables": chained("""SELECT tbl AS "table", min(route)::BIGINT AS route FROM (SELECT tbl, 3 AS route FROM tabs WHERE domain IN ('item', 'world') UNION ALL
      SELECT tbl, 2 FROM cols WHERE EXISTS (SELECT 1 FROM unnest([2, 3, 4]) AS a(l), range(1, 11) AS b(i) WHERE i + l <= 11 AND contains(lower(col), substr('itemregion', i::INT, l::INT)))) GROUP BY 1"""),
    "expand_tables": chained("""SELECT tbl AS "table", min(hop)::BIGINT AS hop FROM (SELECT 'nation' AS tbl, 0 AS hop UNION ALL SELECT neighbour, 1 FROM seen WHERE tbl = 'nation' AND confidence >= 0.7) GROUP BY 1 ORDER BY 2, 1 LIMIT 15"""),
    "locate_cell": chained("SELECT chr((65 + ord)::INT) || (SELECT count(*) + 1 FROM nation WHERE n_nationkey <= 7) AS address, true AS exact FROM cols WHERE tbl = 'nation' AND col = 'n_name'"),
    "seed_tables": chained("SELECT entity, tbl AS \"table\" FROM tabs, (VALUES ('nation'), ('world'), ('line')) AS v(entity) WHERE starts_with(tbl, entity) OR domain = entity"),
    "chunk_diff": "SELECT * FROM (VALUES ('part', 'added'), ('region', 'changed'), ('gone', 'removed')) AS v(\"table\", change)",
    "report_recall": chained("""SELECT * FROM (SELECT 'table' AS kind, tbl AS name, CASE WHEN tbl = 'nation' THEN 1.0::DOUBLE WHEN starts_with(tbl, 'nation') THEN 0.7::DOUBLE WHEN contains(tbl, 'nation') THEN 0.3::DOUBLE END AS score FROM tabs UNION ALL
      SELECT 'column', tbl || '.' || col, CASE WHEN col = 'nation' THEN 1.0::DOUBLE WHEN contains(col, 'nation') THEN 0.6::DOUBLE END FROM cols UNION ALL
      SELECT 'relation', from_table || '.' || from_column || '->' || to_table || '.' || to_column, CASE WHEN contains(from_table || '.' || from_column || '->' || to_table || '.' || to_column, 'nation') THEN 0.8::DOUBLE END FROM relations) WHERE score IS NOT NULL"""),
    "report_nodes": chained('SELECT t.tbl AS "table", domain, count(s.tbl) AS degree, least(greatest(2.0::DOUBLE, 2 + count(s.tbl) / 10), 8.0::DOUBLE) AS size FROM tabs t LEFT JOIN seen s ON s.tbl = t.tbl GROUP BY 1, 2'),
    "report_edges": chained("SELECT from_table, to_table, from_column || '->' || to_column AS label, confidence FROM relations"),
}


def _centrality(rounds: int = 100) -> str:
    """PageRank with a common table per round."""
    parts = [
        "arcs AS MATERIALIZED (SELECT DISTINCT from_table AS x, to_table AS y FROM relations)",
        "fan AS MATERIALIZED (SELECT x, count(*) AS n FROM arcs GROUP BY x)",
        "r0 AS MATERIALIZED (SELECT tbl, 1.0::DOUBLE / (SELECT count(*) FROM tabs) AS v FROM tabs)",
    ]
    for k in range(1, rounds + 1):
        given = f"(SELECT y, sum(v / n) AS g FROM arcs JOIN fan USING (x) JOIN r{k - 1} ON tbl = x GROUP BY y)"
        parts.append(f"r{k} AS MATERIALIZED (SELECT tbl, 0.15::DOUBLE / (SELECT count(*) FROM tabs) + 0.85::DOUBLE * coalesce(g, 0) AS v FROM tabs LEFT JOIN {given} ON y = tbl)")
    select = f'SELECT tbl AS "table", floor(v / (SELECT max(v) FROM r{rounds}) * 10000 + 0.5) / 100 AS score FROM r{rounds}'
    return chained(select, ",\n".join(parts))


ORACLES["centrality"] = _centrality()
ORACLES["critical_path"] = chained(
    "SELECT array_to_string(p, '>') AS path, (len(p) - 1)::INT AS hops FROM long ORDER BY hops DESC, path LIMIT 1",
    """arcs AS MATERIALIZED (SELECT DISTINCT from_table AS x, to_table AS y FROM relations WHERE from_table <> to_table),
    reach(x, y) AS (SELECT x, y FROM arcs UNION SELECT r.x, a.y FROM reach r JOIN arcs a ON r.y = a.x),
    free AS MATERIALIZED (SELECT t FROM (SELECT x AS t FROM arcs UNION SELECT y FROM arcs) WHERE t NOT IN (SELECT x FROM reach WHERE x = y) AND t NOT IN (SELECT y FROM reach WHERE x IN (SELECT x FROM reach WHERE x = y))),
    long(p) AS (SELECT [t] FROM free UNION ALL SELECT list_append(p, y) FROM long JOIN arcs ON x = p[-1] WHERE y IN (SELECT t FROM free))""",
)


def _communities() -> str:
    """Label propagation, one table after the other, in order of the MD5 of their names, until a round changes nothing."""
    parts = [
        "arcs AS MATERIALIZED (SELECT DISTINCT from_table AS x, to_table AS y FROM relations WHERE from_table <> to_table)",
        "voters AS MATERIALIZED (SELECT x, y FROM arcs UNION ALL SELECT y, x FROM arcs)",
        "ord AS MATERIALIZED (SELECT tbl, row_number() OVER (ORDER BY md5(tbl), tbl) AS k FROM tabs)",
        """graph AS MATERIALIZED (SELECT list(tbl ORDER BY k) AS names, list(beside ORDER BY k) AS beside, count(*) AS n FROM (
           SELECT o.tbl, o.k, coalesce(list(p.k) FILTER (p.k IS NOT NULL), []) AS beside FROM ord o LEFT JOIN voters v ON v.x = o.tbl LEFT JOIN ord p ON p.tbl = v.y GROUP BY o.tbl, o.k))""",
        """spread(step, i, labels, moved, done) AS (SELECT 0, 1::BIGINT, names, false, false FROM graph UNION ALL
           SELECT step + 1, CASE WHEN i = n THEN 1 ELSE i + 1 END, list_transform(range(1, n + 1), lambda k: CASE WHEN k = i THEN best ELSE labels[k] END),
             i < n AND (moved OR best <> labels[i]), i = n AND NOT (moved OR best <> labels[i])
           FROM (SELECT *, CASE WHEN len(votes) = 0 THEN labels[i] ELSE list_sort(list_transform(list_distinct(votes), lambda v: {'n': -len(list_filter(votes, lambda w: w = v)), 'v': v}))[1].v END AS best
             FROM (SELECT s.*, g.n, list_transform(g.beside[s.i], lambda k: s.labels[k]) AS votes FROM spread s, graph g WHERE NOT s.done)))""",
        "settled AS MATERIALIZED (SELECT unnest(names) AS tbl, unnest(labels) AS label FROM (SELECT labels FROM spread ORDER BY step DESC LIMIT 1), graph)",
    ]
    select = 'SELECT tbl AS "table", community FROM (SELECT tbl, count(*) OVER (PARTITION BY label) AS n, min(tbl) OVER (PARTITION BY label) AS community FROM settled) WHERE n > 1'
    return chained(select, ",\n".join(parts))


ORACLES["communities"] = _communities()
ORACLES["changelog"] = chained("""SELECT "table", 'schema_changed' AS change_type, string_agg(change || ' ' || col, '; ' ORDER BY change || ' ' || col) AS details FROM (
    SELECT coalesce(a.tbl, b.tbl) AS "table", coalesce(a.col, b.col) AS col, CASE WHEN b.col IS NULL THEN 'added' WHEN a.col IS NULL THEN 'removed' ELSE 'type_changed' END AS change, a.dtype AS now, b.dtype AS before
    FROM typed a FULL JOIN (SELECT tbl, col, CASE WHEN col = 'o_totalprice' THEN 'str' ELSE dtype END AS dtype FROM typed WHERE col <> 'p_size' UNION ALL SELECT 'nation', 'n_comment', 'str') b ON a.tbl = b.tbl AND a.col = b.col)
    WHERE now IS DISTINCT FROM before GROUP BY 1""")
ORACLES["llm_chunks"] = chained("""SELECT tbl AS "table", '# ' || tbl || ' (' || domain || ', ' || row_count || ' rows)' || chr(10) || listed || coalesce(chr(10) || joined, '') AS chunk FROM tabs
    JOIN (SELECT tbl, string_agg(col || ':' || dtype || CASE WHEN is_pk THEN ' PK' ELSE '' END || CASE WHEN is_fk THEN ' FK?' ELSE '' END || CASE WHEN is_enum THEN ' enum(' || uniq || ')' ELSE '' END, ', ' ORDER BY ord) AS listed
      FROM cols WHERE ord < 25 GROUP BY tbl) USING (tbl)
    LEFT JOIN (SELECT tbl, string_agg(line, chr(10) ORDER BY line) AS joined FROM (SELECT tbl, direction || ' ' || join_text || CASE WHEN confidence >= 0.8 THEN ' [certain]' ELSE ' [likely]' END AS line,
      row_number() OVER (PARTITION BY tbl, direction ORDER BY confidence DESC, join_text) AS r FROM seen WHERE confidence >= 0.65) WHERE r <= 10 GROUP BY tbl) USING (tbl)""")
ORACLES["build_context"] = f"""SELECT 'chunk' AS kind, chunk AS text FROM ({ORACLES["llm_chunks"]}) WHERE "table" IN ('nation', 'region', 'customer') UNION ALL
    SELECT 'join', 'JOIN ' || from_table || '.' || from_column || ' = ' || to_table || '.' || to_column FROM ({ORACLES["final_relations"]})
    WHERE confidence >= 0.7 AND from_table IN ('nation', 'region', 'customer') AND to_table IN ('nation', 'region', 'customer')"""
ORACLES["table_detail"] = chained("""SELECT 'column' AS kind, col AS item, detail FROM (SELECT col FROM cols WHERE tbl = 'nation')
    LEFT JOIN (SELECT col, string_agg(value, ',' ORDER BY value) AS detail FROM ranked WHERE tbl = 'nation' AND rank <= 10 GROUP BY col) USING (col) UNION ALL
    SELECT 'relation', join_text, direction FROM (SELECT join_text, direction FROM seen WHERE tbl = 'nation' AND confidence >= 0.6 ORDER BY confidence DESC, join_text LIMIT 20)""")
ORACLES["rank_tables"] = f"""WITH profile AS MATERIALIZED ({ORACLES["table_profile"]}), central AS MATERIALIZED ({ORACLES["centrality"]}), modules AS MATERIALIZED ({ORACLES["communities"]})
    SELECT p."table", floor((coalesce(score, 0.0::DOUBLE) * 1.5::DOUBLE / 100 + CASE WHEN row_count <= 200 THEN 0.5::DOUBLE ELSE 0 END
      + CASE WHEN community IN (SELECT community FROM modules WHERE "table" = 'nation') THEN 1.0::DOUBLE ELSE 0 END) * 10000 + 0.5) / 10000 AS score
    FROM profile p LEFT JOIN central c ON c."table" = p."table" LEFT JOIN modules m ON m."table" = p."table" ORDER BY 2 DESC, 1 LIMIT 10"""
ORACLES["table_profiles"] = chained("""SELECT tbl AS "table", '{"domain":"' || domain || '","row_count":' || row_count || coalesce(',"primary_key":"' || pk || '"', '') || ',"columns":[' || told || '],"relations":[' || coalesce(met, '') || ']}' AS profile,
    array_to_string(list_filter(found, lambda w, i: list_position(found, w) = i), ' ') AS searchable_text FROM (
      SELECT *, [tbl] || string_split(tbl, '_') || [domain] || listed || coalesce(beside, []) || [CASE WHEN row_count < 500 THEN 'small' WHEN row_count < 5000 THEN 'medium' ELSE 'large' END] AS found FROM tabs
      JOIN (SELECT tbl, list(col ORDER BY ord) AS listed, string_agg('{"ordinal":' || ord || ',"column":"' || col || '","dtype":"' || dtype || '","is_pk":' || is_pk || ',"is_fk_candidate":' || is_fk || ',"is_enum":' || is_enum || '}', ',' ORDER BY ord) AS told
        FROM cols GROUP BY tbl) USING (tbl)
      LEFT JOIN (SELECT tbl, list(neighbour ORDER BY -confidence, direction, neighbour, join_text) AS beside,
        string_agg('{"order":' || (-confidence) || ',"direction":"' || direction || '","neighbour":"' || neighbour || '","join_text":"' || join_text || '"}', ',' ORDER BY -confidence, direction, neighbour, join_text) AS met
        FROM seen WHERE confidence >= 0.5 GROUP BY tbl) USING (tbl))""")
ORACLES["analysis"] = f"""SELECT 'cycle' AS kind, cycle AS item, n_tables::DOUBLE AS score FROM ({ORACLES["cycles"]}) UNION ALL SELECT 'centrality', "table", score FROM ({ORACLES["centrality"]}) UNION ALL
    SELECT 'module', string_agg("table", ',' ORDER BY "table"), count(*) FROM ({ORACLES["communities"]}) GROUP BY community UNION ALL SELECT 'orphan', "table", 0 FROM ({ORACLES["orphans"]}) UNION ALL
    SELECT 'critical_path', path, hops + 1 FROM ({ORACLES["critical_path"]})"""
_SECTIONS = "(VALUES ('cycle', 0, 'Cycles', 5), ('centrality', 1, 'Central tables', 5), ('module', 2, 'Modules', 5), ('orphan', 3, 'Tables without relations', 10), ('critical_path', 4, 'Longest chain', 1)) AS v(kind, section, heading, most)"
ORACLES["analysis_summary"] = f"""WITH told AS MATERIALIZED ({ORACLES["analysis"]}), named AS (SELECT * FROM {_SECTIONS})
    SELECT section::INT AS section, 0 AS place, heading || ': ' || (SELECT count(*) FROM told t WHERE t.kind = named.kind) AS text FROM named UNION ALL
    SELECT section::INT, r::INT, CASE WHEN kind = 'orphan' THEN item ELSE item || ' (' || regexp_replace(CAST(score AS VARCHAR), '\\.0$', '') || ')' END
    FROM (SELECT *, row_number() OVER (PARTITION BY kind ORDER BY score DESC, item) AS r FROM told) JOIN named USING (kind) WHERE r <= most"""
ORACLES["summary_text"] = f"""WITH told AS MATERIALIZED ({ORACLES["analysis"]}), shown AS (SELECT *, row_number() OVER (PARTITION BY kind ORDER BY CASE WHEN kind = 'orphan' THEN 0 ELSE score END DESC, item) AS r FROM told)
    SELECT 0::INT AS section, '' AS place, '# Schema Summary — ' || (SELECT count(*) FROM ({ORACLES["table_profile"]})) || ' tables, ' || (SELECT count(*) FROM ({ORACLES["final_relations"]})) || ' relations' AS text
    UNION ALL SELECT * FROM (VALUES (1, '', ''), (2, '', '可用配置表（按业务域分组）：'), (4, '', ''), (5, '', '## 分析洞察'))
    UNION ALL SELECT 3, domain, '[' || domain || '] ' || replace(tables, ',', ', ') FROM ({ORACLES["schema_summary"]})
    UNION ALL SELECT 6, '', '核心枢纽表 Top5: ' || string_agg(item || '(' || CAST(CAST(floor(score * 10 + 0.5) / 10 AS DECIMAL(10, 1)) AS VARCHAR) || ')', ', ' ORDER BY r) FROM shown WHERE kind = 'centrality' AND r <= 5 HAVING count(*) > 0
    UNION ALL SELECT 7, '', '孤立表(' || count(*) || '): ' || string_agg(item, ', ' ORDER BY r) FILTER (r <= 15) || CASE WHEN count(*) > 15 THEN '...' ELSE '' END FROM shown WHERE kind = 'orphan' HAVING count(*) > 0
    UNION ALL SELECT 8, '', '循环依赖: ' || CASE WHEN count(*) > 0 THEN count(*) || ' 个' ELSE '无' END FROM told WHERE kind = 'cycle'
    UNION ALL SELECT 9, '', '业务模块数: ' || count(*) FROM told WHERE kind = 'module' HAVING count(*) > 0"""
ORACLES["chunks_text"] = f"""WITH lines AS (SELECT "table", ['', '#' || string_split(chunk, chr(10))[1]] || string_split(chunk, chr(10))[2:] AS l FROM ({ORACLES["llm_chunks"]}))
    SELECT '' AS "table", 0::INT AS place, '# Schema Graph LLM Export' AS text
    UNION ALL SELECT '', 1, '# ' || (SELECT count(*) FROM ({ORACLES["table_profile"]})) || ' tables, ' || (SELECT count(*) FROM ({ORACLES["final_relations"]})) || ' relations'
    UNION ALL SELECT "table", (generate_subscripts(l, 1) - 1)::INT, unnest(l) FROM lines"""


def _sheet_chain(select: str) -> str:
    """The chain over what ``library_refresh`` leaves of four tables written as sheets: all cells are texts."""
    kept = {"nation": "nation", "customer": "customer", "supplier": "supplier", "client": "(SELECT * FROM customer WHERE c_custkey % 2 = 0)"}
    cells = []
    for table, source in kept.items():
        for k, c in enumerate(SOURCES["customer" if table == "client" else table].split()):
            name, kind = c.split(":")
            cells.append(f"SELECT '{table}' AS tbl, {k} AS ord, '{name}' AS col, 'str' AS kind, {_text(name, kind)} AS value, count(*) AS n FROM {source} GROUP BY ALL")
    parts = [f"{n} AS MATERIALIZED ({BODY[n] if n != 'cells' else chr(10) + ' UNION ALL '.join(cells)})" for n in _needed(select)]
    return "WITH " + ",\n".join(parts) + "\n" + select


ORACLES["library_refresh"] = _sheet_chain(f"SELECT {EDGE} FROM relations")
