"""DuckDB oracle SQL, one statement per registered query.

Written independently of the Spark code: dedups are ``row_number() ... = 1``
windows, null-safe joins are ``IS NOT DISTINCT FROM``, votes are ``CASE``
expressions over per-model scores, candidate lists come from the flat
correspondence instead of the rendered prompt, and the top-k is a full
``list_cosine_similarity`` ranking.  The stand-in tables are re-derived here
from the base views with the same rules as ``recoda.sources.fixtures``.
"""

from __future__ import annotations

from recoda.functions import constants as K
from recoda.sources import fixtures as FX
from recoda.sources import templates as T

NL = "chr(10)"
ATTRS = K.ATTRIBUTE_COLUMNS


def lit(s: str) -> str:
    """A SQL string literal (newlines kept, quotes doubled)."""
    return "'" + s.replace("'", "''") + "'"


def _code(n: str, div: int, letter0: int, mod: int) -> str:
    return (f"(lpad(cast(cast(floor(({n}) / {div}) as bigint) % 10000 as varchar), 4, '0')"
            f" || chr(cast({letter0} + ({n}) % {mod} as integer)))")


def c08(n: str) -> str:
    return _code(n, 3, 65, 3)


def c25(n: str) -> str:
    return _code(n, 2, 70, 4)


def tgt(n: str, k: str) -> str:
    return f"cast(floor((2 * ({n}) + ({k})) / 3) as bigint)"


def dot(c: str) -> str:
    return f"(substr({c}, 1, 2) || '.' || substr({c}, 3))"


def nn(c: str) -> str:
    """Non-null and non-empty."""
    return f"coalesce({c}, '') <> ''"


def attrs(prefix: str = "") -> str:
    return ", ".join(f"{prefix}{a}" for a in ATTRS)


def asc_nulls_first(cols) -> str:
    return ", ".join(f"{c} ASC NULLS FIRST" for c in cols)


def with_(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


# ------------------------------------------------------------------ stand-in tables

CORR = f"""corr AS (
  SELECT {c08('p_partkey')} AS code08, 'old ' || p_name AS label08,
         {c25(tgt('p_partkey', 'k'))} AS code25, 'new ' || p_type || ' ' || p_brand AS label25,
         p_partkey * 3 + k AS pos
  FROM (SELECT p_partkey, p_name, p_type, p_brand, unnest(range(0, p_partkey % 3 + 1)) AS k FROM part) t
  QUALIFY row_number() OVER (PARTITION BY code08, code25, k ORDER BY p_partkey) = 1)"""

NOTES = f"""notes_raw AS (
  SELECT {c25('p_partkey')} AS code25, 'title ' || p_name AS title,
         CASE WHEN p_partkey % 5 <> 0 THEN 'general ' || p_type END AS note_generale,
         CASE WHEN p_partkey % 2 = 0 THEN 'includes ' || p_name || ' fin2' END AS comprend,
         CASE WHEN p_partkey % 3 = 0 THEN 'also ' || p_brand END AS comprend_aussi,
         CASE WHEN p_partkey % 4 = 0 THEN 'excludes ' || p_type END AS ne_comprend_pas,
         p_partkey AS npos
  FROM part),
notes1 AS (
  SELECT code25, title,
         CASE WHEN comprend IS NULL AND comprend_aussi IS NULL THEN NULL
              ELSE concat_ws({NL}, comprend, comprend_aussi) END AS include,
         ne_comprend_pas AS not_include, note_generale AS notes
  FROM notes_raw
  QUALIFY row_number() OVER (PARTITION BY code25 ORDER BY npos) = 1)"""

EXTRACTION = f"""extraction AS (
  SELECT cast(l_orderkey as varchar) AS liasse_numero, l_linenumber AS row_seq,
         {c08('l_partkey')} AS apet_finale,
         CASE WHEN l_linenumber % 2 = 0 THEN upper(p_name) ELSE p_name END AS libelle,
         l_returnflag AS evenement_type,
         cast(l_suppkey % 3 as varchar) AS cj,
         CASE WHEN l_quantity >= 10 THEN 'N' END AS activ_nat_et,
         l_linestatus AS liasse_type,
         cast(cast(floor(l_quantity / 25) as integer) as varchar) AS activ_surf_et,
         CASE WHEN l_partkey % 5 = 0 THEN p_type END AS activ_sec_agri_et,
         CASE WHEN l_partkey % 7 = 0 THEN p_brand END AS activ_nat_lib_et,
         cast(l_partkey % 2 as varchar) AS activ_perm_et
  FROM lineitem JOIN part ON l_partkey = p_partkey)"""

GROUND_TRUTH = f"""ground_truth AS (
  SELECT cast(l_orderkey as varchar) AS liasse_numero, l_linenumber AS g_seq,
         {c25(tgt('l_partkey', 'l_orderkey % 3'))} AS apet_manual, {c08('l_partkey')} AS NAF2008_code
  FROM lineitem WHERE l_linestatus = 'F')"""

HUMAN = f"""human AS (
  SELECT liasse_numero, apet_manual, NAF2008_code FROM ground_truth
  QUALIFY row_number() OVER (PARTITION BY liasse_numero
                             ORDER BY {asc_nulls_first(['g_seq', 'apet_manual', 'NAF2008_code'])}) = 1)"""


def _pred(model: str) -> str:
    null_mod, spread = FX.MODEL_RULES[model]
    code = f"CASE WHEN l_orderkey % {null_mod} = 0 THEN NULL ELSE {c25(tgt('on_', f'l_orderkey % {spread}'))} END"
    return (f"SELECT '{model}' AS model, cast(l_orderkey as varchar) AS liasse_numero, {code} AS nace2025, "
            f"({code}) IS NOT NULL AND l_orderkey % 13 <> 0 AS codable FROM pbase")


PREDICTIONS = ("pbase AS (SELECT l_orderkey, min(l_partkey) AS on_ FROM lineitem GROUP BY l_orderkey),\n"
               "predictions AS (" + "\nUNION ALL ".join(_pred(m) for m in FX.MODELS) + ")")
PRED_A = "pred_a AS (SELECT liasse_numero, nace2025, codable FROM predictions WHERE model = 'a')"

AMB = "amb AS (SELECT code08 FROM corr GROUP BY code08 HAVING count(*) > 1)"
SINGLE = "single AS (SELECT code08, min(code25) AS code25 FROM corr GROUP BY code08 HAVING count(*) = 1)"


def workset_ctes(annotated: bool) -> list[str]:
    gt_filter = "AND liasse_numero IN (SELECT liasse_numero FROM ground_truth)" if annotated else ""
    d1_order = ["row_seq", "apet_finale", *ATTRS]
    return [
        f"ws_f AS (SELECT * FROM extraction WHERE apet_finale IN (SELECT code08 FROM amb) {gt_filter})",
        f"ws_d1 AS (SELECT * FROM ws_f QUALIFY row_number() OVER (PARTITION BY liasse_numero "
        f"ORDER BY {asc_nulls_first(d1_order)}) = 1)",
        f"ws AS (SELECT {', '.join(K.EXTRACTION_COLUMNS)} FROM ws_d1 QUALIFY row_number() OVER "
        f"(PARTITION BY {attrs()} ORDER BY {asc_nulls_first(['liasse_numero', 'row_seq', 'apet_finale'])}) = 1)",
    ]


DECL = (f"decl AS (SELECT liasse_numero, {attrs()} FROM extraction QUALIFY row_number() OVER "
        f"(PARTITION BY liasse_numero ORDER BY {asc_nulls_first(['row_seq', *ATTRS])}) = 1)")

WIDE = (
    ",\n".join(
        f"p{m} AS (SELECT liasse_numero, nace2025, codable FROM predictions WHERE model = '{m}' "
        f"QUALIFY row_number() OVER (PARTITION BY liasse_numero ORDER BY nace2025 ASC NULLS FIRST, codable ASC NULLS FIRST) = 1)"
        for m in FX.MODELS
    )
    + ",\nwide AS (SELECT pa.liasse_numero, "
    + ", ".join(f"p{m}.nace2025 AS nace2025_{m}, p{m}.codable AS codable_{m}" for m in FX.MODELS)
    + " FROM pa JOIN pb ON pa.liasse_numero = pb.liasse_numero JOIN pc ON pa.liasse_numero = pc.liasse_numero)"
)

A, B, C = "nace2025_a", "nace2025_b", "nace2025_c"


def eq(x: str, y: str) -> str:
    return f"coalesce({x} = {y}, false)"


CASCADE = f"coalesce({A}, {B}, {C})"
VOTE = (f"CASE WHEN {A} IS NOT NULL AND ({eq(A, B)} OR {eq(A, C)}) THEN {A} "
        f"WHEN {B} IS NOT NULL AND {eq(B, C)} THEN {B} ELSE coalesce({A}, {B}, {C}) END")


def weighted_sql(mode: str, w=FX.MODEL_WEIGHTS) -> str:
    """Score each model's label, keep the labels with the top score; one -> it, several -> model a."""
    wa, wb, wc = (f"cast({x} as double)" for x in w)
    if mode == "last":
        sa = f"CASE WHEN {eq(C, A)} THEN {wc} WHEN {eq(B, A)} THEN {wb} ELSE {wa} END"
        sb = f"CASE WHEN {eq(C, B)} THEN {wc} ELSE {wb} END"
        sc = wc
    else:
        sa = f"{wa} + CASE WHEN {eq(B, A)} THEN {wb} ELSE 0 END + CASE WHEN {eq(C, A)} THEN {wc} ELSE 0 END"
        sb = f"{wb} + CASE WHEN {eq(A, B)} THEN {wa} ELSE 0 END + CASE WHEN {eq(C, B)} THEN {wc} ELSE 0 END"
        sc = f"{wc} + CASE WHEN {eq(A, C)} THEN {wa} ELSE 0 END + CASE WHEN {eq(B, C)} THEN {wb} ELSE 0 END"
    s = {A: f"CASE WHEN {A} IS NULL THEN -1 ELSE {sa} END",
         B: f"CASE WHEN {B} IS NULL THEN -1 ELSE {sb} END",
         C: f"CASE WHEN {C} IS NULL THEN -1 ELSE {sc} END"}
    top = f"greatest({s[A]}, {s[B]}, {s[C]})"
    winners = f"list_distinct(list_filter([{', '.join(f'CASE WHEN {s[x]} = {top} THEN {x} END' for x in (A, B, C))}], lambda v: v IS NOT NULL))"
    return (f"CASE WHEN {A} IS NULL AND {B} IS NULL AND {C} IS NULL THEN NULL "
            f"WHEN len({winners}) = 1 THEN {winners}[1] ELSE {A} END")


def ensembles_cte(src: str = "wide") -> str:
    return (f"wide_ens AS (SELECT *, {CASCADE} AS nace2025_cascade, {VOTE} AS nace2025_vote, "
            f"{weighted_sql('last')} AS nace2025_weighted FROM {src})")


def lvl_ok(truth: str, pred: str, i: int) -> str:
    return f"coalesce(substr({truth}, 1, {i}) = substr({pred}, 1, {i}), false)"


def pct_sql(flag: str, where: str | None = None, digits: int | None = 2) -> str:
    x = f"CASE WHEN {flag} THEN 1 ELSE 0 END"
    if where is not None:
        x = f"CASE WHEN coalesce({where}, false) THEN ({x}) END"
    v = f"avg({x}) * cast(100 as double)"
    return f"round_even({v}, {digits})" if digits is not None else v


def activity_sql(text="libelle", agri="activ_sec_agri_et", nature="activ_nat_lib_et") -> str:
    x4 = f"CASE WHEN upper({text}) = {text} AND lower({text}) <> {text} THEN lower({text}) ELSE {text} END"
    return (f"({x4} || CASE WHEN {nn(agri)} THEN {lit(K.AGRI_LINE_PREFIX)} || lower({agri}) ELSE '' END"
            f" || CASE WHEN {nn(nature)} THEN {lit(K.NATURE_LINE_PREFIX)} || lower({nature}) ELSE '' END)")


CAND = f"""cand AS (
  SELECT c.code08,
         string_agg({dot('c.code25')} || ': ' || c.label25 || {NL} || concat_ws({NL} || {NL},
                      CASE WHEN {nn('n.include')} THEN n.include END,
                      CASE WHEN {nn('n.not_include')} THEN n.not_include END,
                      CASE WHEN {nn('n.notes')} THEN n.notes END), {NL} || {NL} ORDER BY c.pos) AS proposed,
         string_agg('''' || {dot('c.code25')} || '''', ', ' ORDER BY c.pos) AS list_codes,
         list(c.code25 ORDER BY c.pos) AS codes
  FROM corr c LEFT JOIN notes1 n ON c.code25 = n.code25
  GROUP BY c.code08)"""


def render_sql(template: str, values: dict[str, str]) -> str:
    out = lit(template)
    for name, v in values.items():
        out = f"replace({out}, {lit('{{' + name + '}}')}, coalesce({v}, ''))"
    return out


def confidence_sql(ids: str, lps: str, code: str) -> str:
    """Mean exp(logprob) over the first exact run of the code's characters in the token ids."""
    t = f"list_transform(string_split({code}, ''), lambda ch: ascii(ch))"
    m = f"len({t})"
    n = f"len({ids})"
    hits = f"list_filter(range(0, {n} - {m} + 1), lambda i: list_slice({ids}, i + 1, i + {m}) = {t})"
    first = f"{hits}[1]"
    mean = f"list_sum(list_transform(list_slice({lps}, {first} + 1, {first} + {m}), lambda x: exp(x))) / {m}"
    return (f"CASE WHEN {code} IS NULL OR {m} = 0 OR {n} < {m} THEN cast(0 as double) "
            f"ELSE coalesce({mean}, cast(0 as double)) END")


def _json_code(code: str) -> str:
    return f"CASE WHEN {code} IS NULL THEN 'null' ELSE '\"' || {dot(code)} || '\"' END"


RESPONSES = f"""responses0 AS (
  SELECT liasse_numero, CASE cast(liasse_numero as bigint) % 13
    WHEN 0 THEN '{{"codable": true, "nace2025": ' || {_json_code('nace2025')} || ', "nace08_valid": '
                || CASE WHEN cast(liasse_numero as bigint) % 4 = 0 THEN 'false' ELSE 'true' END || '}}'
    WHEN 1 THEN 'codable: yes, code ' || coalesce({dot('nace2025')}, 'none')
    WHEN 2 THEN '{{"nace2025": ' || {_json_code('nace2025')} || '}}'
    WHEN 3 THEN '{{"codable": true}}'
    WHEN 4 THEN '{{"codable": false, "nace2025": ' || {_json_code('nace2025')} || '}}'
    WHEN 5 THEN '{{"codable": "true", "nace2025": ' || {_json_code('nace2025')} || ', "confidence": 0.9}}'
    WHEN 6 THEN '{{"codable": true, "nace2025": ' || {_json_code('nace2025')} || '}} as asked'
    WHEN 7 THEN '{{''codable'': true, ''nace2025'': ' || {_json_code('nace2025')} || '}}'
    WHEN 8 THEN '{{"codable": true, "nace2025": 111}}'
    WHEN 9 THEN '{{"codable": true, "nace2025": {{"a": ' || {_json_code('nace2025')} || '}}}}'
    WHEN 10 THEN '{{"codable": true, "nace2025": ' || {_json_code('nace2025')} || ', "confidence": "high"}}'
    WHEN 11 THEN '{{"codable": false, "nace2025": "00.00Z", "codable": true, "nace2025": ' || {_json_code('nace2025')} || '}}'
    ELSE '{{"codable": ' || CASE WHEN cast(liasse_numero as bigint) % 4 = 3 THEN '"On"' ELSE '1.0' END
         || ', "nace2025": ' || {_json_code('nace2025')} || ', "nace08_valid": "no"}}' END AS output_text
  FROM pred_a),
responses AS (
  SELECT liasse_numero, output_text,
         list_transform(string_split(output_text, ''), lambda ch: ascii(ch)) AS token_ids,
         list_transform(range(0, length(output_text)), lambda i: -(i % 10) / cast(10 as double)) AS logprobs
  FROM responses0)"""


def _lax_boolean(field: str) -> str:
    """true / false of a JSON value a lenient validator takes as a boolean, else null."""
    text, kind = f"json_extract_string(js, '$.{field}')", f"json_type(js, '$.{field}')"
    return (f"CASE WHEN {kind} = 'BOOLEAN' THEN {text} = 'true' "
            f"WHEN {kind} IN ('UBIGINT', 'BIGINT', 'DOUBLE') THEN "
            f"CASE cast({text} AS DOUBLE) WHEN 1 THEN true WHEN 0 THEN false END "
            f"WHEN {kind} = 'VARCHAR' THEN CASE WHEN lower({text}) IN ('1', 'on', 't', 'true', 'y', 'yes') THEN true "
            f"WHEN lower({text}) IN ('0', 'off', 'f', 'false', 'n', 'no') THEN false END END")


def parsed_cte(src: str = "responses", name: str = "parsed") -> str:
    absent = lambda f: f"coalesce(json_type(js, '$.{f}'), 'NULL') = 'NULL'"
    return f"""{name}_raw AS (
  SELECT * EXCLUDE (all_js), json_type(all_js) = 'OBJECT' AS is_obj, CASE WHEN json_type(all_js) = 'OBJECT' THEN
    -- of a repeated key the last value counts
    '{{' || array_to_string(list_transform(list_distinct(json_keys(all_js)), lambda k: to_json(k)::VARCHAR || ':' ||
      json_extract(all_js, '$.*')[len(json_keys(all_js)) + 1 - list_position(list_reverse(json_keys(all_js)), k)]::VARCHAR),
      ',') || '}}' ELSE all_js END AS js
  FROM (SELECT *, CASE WHEN json_valid(output_text) THEN output_text ELSE 'null' END AS all_js FROM {src})),
{name}_f AS (
  SELECT *,
    CASE WHEN is_obj THEN {_lax_boolean('codable')} END AS c_b,
    CASE WHEN is_obj AND json_type(js, '$.nace2025') = 'VARCHAR'
         THEN json_extract_string(js, '$.nace2025') END AS code_raw,
    CASE WHEN is_obj THEN {_lax_boolean('nace08_valid')} END AS nv_b,
    CASE WHEN is_obj THEN ({absent('nace2025')} OR json_type(js, '$.nace2025') = 'VARCHAR')
      AND ({absent('nace08_valid')} OR {_lax_boolean('nace08_valid')} IS NOT NULL)
      AND ({absent('confidence')} OR json_type(js, '$.confidence') IN ('UBIGINT', 'BIGINT', 'DOUBLE', 'BOOLEAN')
           OR (json_type(js, '$.confidence') = 'VARCHAR'
               AND try_cast(json_extract_string(js, '$.confidence') AS DOUBLE) IS NOT NULL))
      ELSE false END AS typed
  FROM {name}_raw),
{name}_k AS (
  SELECT *, is_obj AND typed AND c_b IS NOT NULL
            AND NOT (c_b AND coalesce(code_raw, '') = '') AND code_raw IS NOT NULL AS keep
  FROM {name}_f),
{name} AS (
  SELECT liasse_numero,
         CASE WHEN keep THEN c_b ELSE false END AS codable,
         CASE WHEN keep THEN replace(code_raw, '.', '') END AS nace2025,
         CASE WHEN keep AND nv_b THEN 'True' WHEN keep AND NOT nv_b THEN 'False' ELSE 'undefined' END AS nace08_valid,
         round(CASE WHEN keep THEN {confidence_sql('token_ids', 'logprobs', 'code_raw')} ELSE cast(0 as double) END, 6)
           AS confidence,
         keep, c_b
  FROM {name}_k)"""


def _accuracy_long(ev: str) -> str:
    cols = []
    for f in (None, "mapping_ok", "codable"):
        for i in K.ACCURACY_LEVELS:
            cols.append(f"cast({pct_sql(lvl_ok('apet_manual', 'nace2025', i), f)} as double) AS accuracy_{f or 'overall'}_lvl_{i}")
    cols.append("cast(count(*) as double) AS eval_size")
    cols.append("cast(count_if(mapping_ok) as double) AS mapping_ok")
    return f"SELECT metric, value FROM (UNPIVOT (SELECT {', '.join(cols)} FROM {ev}) ON COLUMNS(*) INTO NAME metric VALUE value)"


def eval_ctes(res_sql: str) -> list[str]:
    return [
        f"res AS ({res_sql})",
        "gt AS (SELECT * FROM human WHERE liasse_numero IN (SELECT liasse_numero FROM res))",
        "cov AS (SELECT ws.liasse_numero, list_contains(cand.codes, gt.apet_manual) AS mapping_ok "
        "FROM ws JOIN cand ON ws.apet_finale = cand.code08 JOIN gt ON ws.liasse_numero = gt.liasse_numero)",
        "ev AS (SELECT gt.liasse_numero, gt.apet_manual, cov.mapping_ok, res.nace2025, res.codable "
        "FROM gt JOIN cov ON gt.liasse_numero = cov.liasse_numero JOIN res ON gt.liasse_numero = res.liasse_numero)",
    ]


def coded_long(src: str) -> str:
    return ("SELECT metric, value FROM (UNPIVOT (SELECT cast(count_if(codable) as double) AS num_coded, "
            "cast(count(*) - count_if(codable) as double) AS num_not_coded, "
            f"round_even((count(*) - count_if(codable)) * cast(100 as double) / count(*), 2) AS pct_not_coded FROM {src}) "
            "ON COLUMNS(*) INTO NAME metric VALUE value)")


EVAL_ANNOTATED = [
    *workset_ctes(True),
    "res AS (SELECT * FROM pred_a WHERE liasse_numero IN (SELECT liasse_numero FROM ws))",
    "gt AS (SELECT * FROM human WHERE liasse_numero IN (SELECT liasse_numero FROM res))",
    "cov AS (SELECT ws.liasse_numero, list_contains(cand.codes, gt.apet_manual) AS mapping_ok "
    "FROM ws JOIN cand ON ws.apet_finale = cand.code08 JOIN gt ON ws.liasse_numero = gt.liasse_numero)",
    "ev AS (SELECT gt.liasse_numero, gt.apet_manual, cov.mapping_ok, res.nace2025, res.codable "
    "FROM gt JOIN cov ON gt.liasse_numero = cov.liasse_numero JOIN res ON gt.liasse_numero = res.liasse_numero)",
]

BASE = [CORR, NOTES, EXTRACTION, GROUND_TRUTH, HUMAN, PREDICTIONS, PRED_A, AMB, SINGLE]


def q(*ctes_and_select: str) -> str:
    *ctes, select = ctes_and_select
    return with_(*BASE, *ctes) + select


def _assemble_ctes() -> list[str]:
    on9 = lambda l, r: " AND ".join(f"{l}.{a} IS NOT DISTINCT FROM {r}.{a}" for a in ATTRS)
    return [
        *workset_ctes(False),
        DECL,
        "labels AS (SELECT liasse_numero, nace2025 FROM pred_a WHERE liasse_numero IN (SELECT liasse_numero FROM ws))",
        "univ0 AS (SELECT e.liasse_numero, s.code25 AS nace2025 FROM extraction e JOIN single s ON e.apet_finale = s.code08)",
        "univ AS (SELECT * FROM univ0 QUALIFY row_number() OVER (PARTITION BY liasse_numero ORDER BY nace2025 ASC NULLS FIRST) = 1)",
        "hum AS (SELECT liasse_numero, apet_manual AS nace2025 FROM ground_truth QUALIFY row_number() OVER "
        "(PARTITION BY liasse_numero ORDER BY g_seq ASC NULLS FIRST, apet_manual ASC NULLS FIRST) = 1)",
        "model AS (SELECT * FROM labels l WHERE NOT EXISTS (SELECT 1 FROM hum h WHERE h.liasse_numero IS NOT DISTINCT FROM l.liasse_numero))",
        f"univ_full AS (SELECT u.liasse_numero, u.nace2025, {attrs('d.')} FROM univ u LEFT JOIN decl d ON u.liasse_numero = d.liasse_numero)",
        f"model_full AS (SELECT m.liasse_numero, m.nace2025, {attrs('d.')} FROM model m LEFT JOIN decl d ON m.liasse_numero = d.liasse_numero)",
        f"human_full0 AS (SELECT h.liasse_numero, h.nace2025, {attrs('d.')} FROM hum h LEFT JOIN decl d ON h.liasse_numero = d.liasse_numero)",
        f"human_full AS (SELECT * FROM human_full0 QUALIFY row_number() OVER (PARTITION BY {attrs()} "
        f"ORDER BY liasse_numero ASC NULLS FIRST, nace2025 ASC NULLS FIRST) = 1)",
        "targets AS (SELECT * FROM decl d WHERE NOT EXISTS (SELECT 1 FROM univ u WHERE u.liasse_numero IS NOT DISTINCT FROM d.liasse_numero))",
        f"model_prop AS (SELECT t.liasse_numero, m.nace2025, {attrs('m.')} FROM model_full m LEFT JOIN targets t ON {on9('m', 't')} "
        f"WHERE t.liasse_numero IS NOT NULL)",
        f"human_prop AS (SELECT t.liasse_numero, h.nace2025, {attrs('h.')} FROM human_full h LEFT JOIN targets t ON {on9('h', 't')} "
        f"WHERE t.liasse_numero IS NOT NULL)",
        "final AS (SELECT * FROM univ_full UNION ALL SELECT * FROM model_prop UNION ALL SELECT * FROM human_prop)",
    ]


def _matrix_sql() -> str:
    strategies = list(FX.MODELS) + ["cascade", "vote", "weighted"]
    cells = []
    for i in K.ACCURACY_LEVELS:
        for s in strategies:
            cells.append(f"cast({pct_sql(lvl_ok('apet_manual', f'nace2025_{s}', i))} as double) AS \"all|{s}|{i}\"")
        for m in FX.MODELS:
            cells.append(f"cast({pct_sql(lvl_ok('apet_manual', f'nace2025_{m}', i), f'codable_{m}')} as double) AS \"codable|{m}|{i}\"")
        for s in strategies:
            cells.append(f"cast({pct_sql(lvl_ok('apet_manual', f'nace2025_{s}', i), 'mapping_ok')} as double) AS \"mapping_ok|{s}|{i}\"")
    return (f"cells AS (SELECT cell, accuracy FROM (UNPIVOT (SELECT {', '.join(cells)} FROM ev_m) "
            f"ON COLUMNS(*) INTO NAME cell VALUE accuracy))")


EV_M = [
    WIDE,
    ensembles_cte(),
    "gt_ok AS (SELECT h.liasse_numero, h.apet_manual, EXISTS (SELECT 1 FROM corr c WHERE c.code08 = h.NAF2008_code "
    "AND c.code25 = h.apet_manual) AS mapping_ok FROM human h)",
    "ev_m AS (SELECT w.*, g.apet_manual, g.mapping_ok FROM wide_ens w JOIN gt_ok g ON w.liasse_numero = g.liasse_numero)",
]

SIM = """sim AS (
  SELECT q.vec_id AS query_id, d.vec_id AS doc_id,
         list_cosine_similarity(cast(q.embedding AS DOUBLE[]), cast(d.embedding AS DOUBLE[])) AS cosine,
         list_inner_product(cast(q.embedding AS DOUBLE[]), cast(d.embedding AS DOUBLE[])) AS dotp
  FROM embeddings q, embeddings d)"""

MAPPING_TEMPLATE = T.MAPPING_USER
PROMPT_USER = render_sql(MAPPING_TEMPLATE, {
    "nace_old": dot("ws.apet_finale"),
    "proposed_codes": "cand.proposed",
    "list_proposed_codes": "cand.list_codes",
    "activity": activity_sql("ws.libelle", "ws.activ_sec_agri_et", "ws.activ_nat_lib_et"),
})

INFER_TEXT = f"'{{\"codable\": true, \"nace2025\": \"' || {dot('cand.codes[1]')} || '\", \"nace08_valid\": true}}'"

def letter_vector(text: str) -> str:
    """L2-normalised a-z counts of the lower-cased text, rounded to FLOAT like the embedder's output."""
    counts = "[" + ", ".join(f"length(lower({text})) - length(replace(lower({text}), '{c}', ''))"
                             for c in "abcdefghijklmnopqrstuvwxyz") + "]"
    return (f"cast(list_transform({counts}, lambda x: x / greatest(sqrt(list_sum(list_transform({counts}, "
            f"lambda y: y * y))), 1)) AS FLOAT[])")


LABEL_DOCS = (
    "ld_u AS (SELECT code, label, include, not_include, notes FROM ("
    "SELECT c.code25 AS code, c.label25 AS label, n.include, n.not_include, n.notes, "
    "row_number() OVER (PARTITION BY c.code25 ORDER BY c.code08, c.pos) AS rn "
    "FROM corr c LEFT JOIN notes1 n ON c.code25 = n.code25) WHERE rn = 1),\n"
    f"ld AS (SELECT code, concat_ws({NL} || {NL}, '# ' || {dot('code')} || {lit(K.DOC_TITLE_SEPARATOR)} || label, "
    f"CASE WHEN {nn('notes')} THEN {lit(K.DOC_NOTES_HEADER)} || notes END, "
    f"CASE WHEN {nn('include')} THEN {lit(K.DOC_INCLUDE_HEADER)} || include END, "
    f"CASE WHEN {nn('not_include')} THEN {lit(K.DOC_NOT_INCLUDE_HEADER)} || not_include END) AS content FROM ld_u)"
)

QUOTE = "''''"
RETRIEVAL = [
    *workset_ctes(False),
    LABEL_DOCS,
    f"ract AS (SELECT liasse_numero, {activity_sql()} AS activity FROM ws)",
    f"rq AS (SELECT liasse_numero, activity, "
    f"{letter_vector(render_sql(T.RETRIEVER_USER, {'activity_description': 'activity'}))} AS v FROM ract)",
    f"rd AS (SELECT code, content, {letter_vector('content')} AS v FROM ld)",
    "rtop AS (SELECT q.liasse_numero, d.code, d.content, "
    "list_cosine_similarity(cast(q.v AS DOUBLE[]), cast(d.v AS DOUBLE[])) AS cosine FROM rq q, rd d "
    "QUALIFY row_number() OVER (PARTITION BY q.liasse_numero ORDER BY round(cosine, 12) DESC, d.code ASC) <= 5)",
    f"ragg AS (SELECT liasse_numero, string_agg({lit(K.RETRIEVED_DOC_PREFIX)} || content, {NL} || {NL} "
    f"ORDER BY round(cosine, 12) DESC, code ASC) AS block, string_agg({QUOTE} || {dot('code')} || {QUOTE}, ', ' "
    f"ORDER BY round(cosine, 12) DESC, code ASC) AS listed FROM rtop GROUP BY liasse_numero)",
]
RETRIEVAL_SELECT = (
    "SELECT a.liasse_numero, g.listed AS proposed_codes, "
    + render_sql(T.RETRIEVAL_USER, {"proposed_codes": "g.block", "list_proposed_codes": "g.listed",
                                    "activity": "a.activity"})
    + " AS user_prompt FROM ract a JOIN ragg g ON a.liasse_numero = g.liasse_numero"
)

ORACLE_SQL: dict[str, str] = {
    "prompts_retrieval": q(*RETRIEVAL, RETRIEVAL_SELECT),
    "mapping_nested_size": q(
        "SELECT code08, arg_min(label08, pos) AS label08, cast(count(*) as integer) AS n_targets, "
        "string_agg(code25, ',' ORDER BY pos) AS target_codes, count(*) > 1 AS is_ambiguous FROM corr GROUP BY code08"),
    "mapping_unique_targets": q(
        "SELECT code, code08, label, include, not_include, notes FROM ("
        "SELECT c.code25 AS code, c.code08, c.label25 AS label, n.include, n.not_include, n.notes, "
        "row_number() OVER (PARTITION BY c.code25 ORDER BY c.code08, c.pos) AS rn "
        "FROM corr c LEFT JOIN notes1 n ON c.code25 = n.code25) WHERE rn = 1"),
    "notes_by_kind": q(
        "SELECT c.code08, c.code25, c.pos, n.title, n.include, n.not_include, n.notes "
        "FROM corr c LEFT JOIN notes1 n ON c.code25 = n.code25"),
    "recode_unambiguous": q(
        "SELECT e.liasse_numero, s.code25 AS nace2025 FROM extraction e JOIN single s ON e.apet_finale = s.code08"),
    "recode_streaming": q(
        "SELECT e.liasse_numero, s.code25 AS nace2025 FROM extraction e JOIN single s ON e.apet_finale = s.code08"),
    "workset_ambiguous": q(*workset_ctes(False), "SELECT * FROM ws"),
    "workset_annotated": q(*workset_ctes(True), "SELECT * FROM ws"),
    "workset_thirds": q(
        *workset_ctes(False),
        "pos AS (SELECT liasse_numero, row_number() OVER (ORDER BY liasse_numero) - 1 AS position, "
        "count(*) OVER () AS n FROM ws)",
        "SELECT liasse_numero, cast(position as bigint) AS position, cast(CASE WHEN n < 3 THEN 3 "
        "ELSE least(3, floor(position / (n // 3)) + 1) END as integer) AS shard FROM pos"),
    "enrich_left": q(
        DECL,
        f"SELECT h.liasse_numero, h.apet_manual AS nace2025, {attrs('d.')} FROM human h "
        "LEFT JOIN decl d ON h.liasse_numero = d.liasse_numero"),
    "anti_annotated": q(
        "SELECT p.liasse_numero, p.nace2025 FROM pred_a p WHERE NOT EXISTS "
        "(SELECT 1 FROM human h WHERE h.liasse_numero IS NOT DISTINCT FROM p.liasse_numero)"),
    "propagate_labels": q(*_assemble_ctes(), "SELECT * FROM model_prop"),
    "assemble_final": q(*_assemble_ctes(), "SELECT * FROM final"),
    "assemble_violations": q(
        *_assemble_ctes(),
        "SELECT liasse_numero, count(*) AS n_rows FROM final GROUP BY liasse_numero HAVING count(*) > 1"),
    "models_wide": q(WIDE, "SELECT * FROM wide"),
    "models_common_ids": q(
        "SELECT liasse_numero FROM predictions GROUP BY liasse_numero HAVING count(DISTINCT model) = 3"),
    "ensemble_cascade": q(WIDE, f"SELECT liasse_numero, {CASCADE} AS label FROM wide"),
    "ensemble_vote": q(WIDE, f"SELECT liasse_numero, {VOTE} AS label FROM wide"),
    "ensemble_weighted_last": q(WIDE, f"SELECT liasse_numero, {weighted_sql('last')} AS label FROM wide"),
    "ensemble_weighted_sum": q(WIDE, f"SELECT liasse_numero, {weighted_sql('sum')} AS label FROM wide"),
    "agreement_rows": q(
        WIDE,
        f"ag AS (SELECT liasse_numero, cast(({A} IS NOT NULL)::int + ({B} IS NOT NULL)::int + ({C} IS NOT NULL)::int as integer) "
        f"AS valid_predictions, cast(len(list_distinct(list_filter([{A}, {B}, {C}], lambda v: v IS NOT NULL))) as integer) "
        f"AS unique_predictions FROM wide)",
        "SELECT liasse_numero, valid_predictions, unique_predictions, "
        "unique_predictions = 1 AND valid_predictions = 3 AS full_agreement, "
        "unique_predictions = 1 AND valid_predictions < 3 AS partial_agreement, "
        "unique_predictions = valid_predictions AND valid_predictions > 1 AS all_different, "
        "valid_predictions = 0 AS all_none FROM ag"),
    "agreement_stats": q(
        WIDE,
        f"ag AS (SELECT ({A} IS NOT NULL)::int + ({B} IS NOT NULL)::int + ({C} IS NOT NULL)::int AS v, "
        f"len(list_distinct(list_filter([{A}, {B}, {C}], lambda x: x IS NOT NULL))) AS u FROM wide)",
        "fl AS (SELECT u = 1 AND v = 3 AS f, u = 1 AND v < 3 AS p, u = v AND v > 1 AS d, v = 0 AS z FROM ag)",
        "SELECT count(*) AS total_samples, count_if(f) AS full_agreement_count, count_if(p) AS partial_agreement_count, "
        "count_if(d) AS all_different_count, count_if(z) AS all_none_count, "
        "count_if(f) * cast(100 as double) / count(*) AS full_agreement_pct, "
        "count_if(p) * cast(100 as double) / count(*) AS partial_agreement_pct, "
        "count_if(d) * cast(100 as double) / count(*) AS all_different_pct, "
        "count_if(z) * cast(100 as double) / count(*) AS all_none_pct FROM fl"),
    "agreement_pairs": q(
        WIDE,
        "SELECT " + ", ".join(
            f"{pct_sql(eq(x, y), digits=None)} AS agreement_{x}_vs_{y}" for x, y in ((A, B), (A, C), (B, C))
        ) + " FROM wide"),
    "mapping_ok": q(
        "SELECT h.liasse_numero, h.apet_manual, h.NAF2008_code, EXISTS (SELECT 1 FROM corr c WHERE c.code08 = h.NAF2008_code "
        "AND c.code25 = h.apet_manual) AS mapping_ok FROM human h"),
    "accuracy_levels": q(*EVAL_ANNOTATED[:0], CAND, *EVAL_ANNOTATED, _accuracy_long("ev")),
    "accuracy_matrix": q(
        *EV_M, _matrix_sql(),
        "SELECT split_part(cell, '|', 2) AS strategy, split_part(cell, '|', 1) AS subset, "
        "cast(split_part(cell, '|', 3) as integer) AS level, accuracy FROM cells"),
    "best_strategy": q(
        *EV_M, _matrix_sql(),
        "lvl5 AS (SELECT split_part(cell, '|', 2) AS strategy, accuracy FROM cells WHERE cell LIKE 'all|%|5')",
        "best AS (SELECT strategy FROM lvl5 ORDER BY accuracy DESC NULLS LAST, "
        "list_position(['a', 'b', 'c', 'cascade', 'vote', 'weighted'], strategy) LIMIT 1)",
        "SELECT w.liasse_numero, CASE b.strategy WHEN 'a' THEN w.nace2025_a WHEN 'b' THEN w.nace2025_b "
        "WHEN 'c' THEN w.nace2025_c WHEN 'cascade' THEN w.nace2025_cascade WHEN 'vote' THEN w.nace2025_vote "
        "ELSE w.nace2025_weighted END AS nace2025, b.strategy FROM wide_ens w, best b"),
    "coded_stats": q(
        "SELECT count_if(codable) AS num_coded, count(*) - count_if(codable) AS num_not_coded, "
        "round_even((count(*) - count_if(codable)) * cast(100 as double) / count(*), 2) AS pct_not_coded FROM pred_a"),
    "coverage_pct": q(
        CAND, *workset_ctes(True),
        "cov AS (SELECT ws.liasse_numero, list_contains(cand.codes, h.apet_manual) AS mapping_ok FROM ws "
        "JOIN cand ON ws.apet_finale = cand.code08 JOIN human h ON ws.liasse_numero = h.liasse_numero)",
        f"SELECT count(*) AS n_rows, count_if(mapping_ok) AS n_covered, {pct_sql('mapping_ok', digits=None)} AS pct_mapping_ok FROM cov"),
    "activity_text": q(f"SELECT liasse_numero, row_seq, {activity_sql()} AS activity FROM extraction"),
    "text_case_docs": (
        "SELECT doc_id, CASE WHEN upper(text) = text AND lower(text) <> text THEN lower(text) ELSE text END AS text_cased "
        "FROM documents"),
    "label_documents": q(
        "u AS (SELECT code, code08, label, include, not_include, notes FROM ("
        "SELECT c.code25 AS code, c.code08, c.label25 AS label, n.include, n.not_include, n.notes, "
        "row_number() OVER (PARTITION BY c.code25 ORDER BY c.code08, c.pos) AS rn "
        "FROM corr c LEFT JOIN notes1 n ON c.code25 = n.code25) WHERE rn = 1)",
        f"SELECT code, coalesce(label, '') AS label, coalesce(include, '') AS include, "
        f"coalesce(not_include, '') AS not_include, coalesce(notes, '') AS notes, "
        f"concat_ws({NL} || {NL}, '# ' || {dot('code')} || {lit(K.DOC_TITLE_SEPARATOR)} || label, "
        f"CASE WHEN {nn('notes')} THEN {lit(K.DOC_NOTES_HEADER)} || notes END, "
        f"CASE WHEN {nn('include')} THEN {lit(K.DOC_INCLUDE_HEADER)} || include END, "
        f"CASE WHEN {nn('not_include')} THEN {lit(K.DOC_NOT_INCLUDE_HEADER)} || not_include END) AS content FROM u"),
    "prompts_mapping": q(
        CAND, *workset_ctes(False),
        f"SELECT ws.liasse_numero, cand.list_codes AS proposed_codes, {lit(T.MAPPING_SYSTEM)} AS system_prompt, "
        f"{PROMPT_USER} AS user_prompt FROM ws LEFT JOIN cand ON ws.apet_finale = cand.code08"),
    "prompt_dataset_codes": q(
        CAND, *workset_ctes(True),
        "SELECT ws.liasse_numero, list_contains(cand.codes, h.apet_manual) AS mapping_ok, "
        "cast(list_position(cand.codes, h.apet_manual) - 1 as integer) AS position FROM ws "
        "JOIN cand ON ws.apet_finale = cand.code08 JOIN human h ON ws.liasse_numero = h.liasse_numero"),
    "chat_messages_user_text": (
        "WITH n AS (SELECT conv_id, count(*) AS n_messages FROM conversations GROUP BY conv_id), "
        "s AS (SELECT conv_id, role AS user_role, text AS user_text FROM conversations "
        "QUALIFY row_number() OVER (PARTITION BY conv_id ORDER BY turn, role, text) = 2) "
        "SELECT n.conv_id, n.n_messages, s.user_role, s.user_text FROM n LEFT JOIN s ON n.conv_id = s.conv_id"),
    "similar_topk": (
        "WITH " + SIM + " SELECT query_id, doc_id, round(cosine, 6) AS score, cast(rank as integer) AS rank FROM ("
        "SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY round(cosine, 12) DESC, doc_id ASC) AS rank FROM sim) "
        "WHERE rank <= 5"),
    "index_search_exact": (
        "WITH " + SIM + " SELECT query_id, doc_id, round(cosine, 6) AS score, cast(rank as integer) AS rank FROM ("
        "SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY round(cosine, 12) DESC, doc_id ASC) AS rank FROM sim "
        "WHERE query_id % 20 = 0) WHERE rank <= 5"),
    "similar_rerank": (
        "WITH " + SIM + ", top35 AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY query_id "
        "ORDER BY round(cosine, 12) DESC, doc_id ASC) AS r1 FROM sim) WHERE r1 <= 35) "
        "SELECT query_id, doc_id, round(dotp, 6) AS score, cast(rank as integer) AS rank FROM ("
        "SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY dotp DESC, doc_id ASC) AS rank FROM top35) "
        "WHERE rank <= 5"),
    "responses_parsed": q(
        RESPONSES, parsed_cte(),
        "SELECT liasse_numero, codable, nace2025, nace08_valid, confidence FROM parsed"),
    "responses_status": q(
        RESPONSES, parsed_cte(),
        "SELECT CASE WHEN keep AND c_b THEN 'codable' WHEN keep THEN 'declined_with_code' ELSE 'fallback' END AS status, "
        "count(*) AS n FROM parsed GROUP BY 1"),
    "confidence_scores": q(
        RESPONSES,
        parsed_cte(),
        f"SELECT liasse_numero, round({confidence_sql('token_ids', 'logprobs', 'coalesce(code_raw, ' + chr(39) * 2 + ')')}, 6) "
        f"AS confidence FROM parsed_f"),
    "infer_batch": q(
        CAND, *workset_ctes(False),
        f"answers0 AS (SELECT ws.liasse_numero, {INFER_TEXT} AS output_text FROM ws JOIN cand ON ws.apet_finale = cand.code08)",
        "answers AS (SELECT liasse_numero, output_text, "
        "list_transform(string_split(output_text, ''), lambda ch: ascii(ch)) AS token_ids, "
        "list_transform(range(0, length(output_text)), lambda i: -(i % 10) / cast(10 as double)) AS logprobs FROM answers0)",
        parsed_cte("answers", "pa2"),
        "SELECT liasse_numero, codable, nace2025, nace08_valid, confidence FROM pa2"),
    "infer_resumed": q(
        CAND, *workset_ctes(False),
        f"answers AS (SELECT ws.liasse_numero, {INFER_TEXT} AS output_text FROM ws JOIN cand ON ws.apet_finale = cand.code08)",
        "SELECT liasse_numero, output_text, cast(length(output_text) as integer) AS n_tokens FROM answers"),
    "results_roundtrip": q(
        RESPONSES, parsed_cte(),
        "SELECT liasse_numero, codable, nace2025, nace08_valid, confidence, 'org/model-a.5' AS model, '2024-11-13--00-39' AS run_id FROM parsed"),
    "runs_by_path": q(
        RESPONSES, parsed_cte(),
        "SELECT liasse_numero, codable, nace2025, 'org/model-a.5' AS model, r.run_id FROM parsed, "
        "(SELECT unnest(['2024-11-13--00-39', '2024-11-15--01-13']) AS run_id) r"),
    "encode_ambiguous_metrics": q(
        CAND, *workset_ctes(True),
        *eval_ctes("SELECT ws.liasse_numero, cand.codes[1] AS nace2025, true AS codable "
                   "FROM ws JOIN cand ON ws.apet_finale = cand.code08"),
        f"acc AS ({_accuracy_long('ev')})",
        f"coded AS ({coded_long('res')})",
        "SELECT * FROM acc UNION ALL SELECT * FROM coded"),
    "embeddings_roundtrip": q(
        LABEL_DOCS,
        f"lv AS (SELECT code, {letter_vector('content')} AS v FROM ld)",
        "SELECT code, 'letter-count-26' AS model, cast(26 as integer) AS dims, 'letter-count-26' AS collection_model, "
        "array_to_string(list_transform(v, lambda x: cast(cast(round(round(cast(x AS DOUBLE), 6) * 1000000) AS BIGINT) "
        "AS VARCHAR)), ',') AS values FROM lv"),
    "collection_updated": q(
        LABEL_DOCS,
        f"lv AS (SELECT code, content, {letter_vector('content')} AS v FROM ld)",
        "SELECT code, length(content) % 2 = 1 AS embedded, 'letter-count-26' AS model, "
        "array_to_string(list_transform(v, lambda x: cast(cast(round(round(cast(x AS DOUBLE), 6) * 1000000) AS BIGINT) "
        "AS VARCHAR)), ',') AS values FROM lv"),
    "sheets_by_position": q(
        "SELECT code08, arg_min(label08, pos) AS label08, cast(count(*) as integer) AS n_targets, "
        "string_agg(code25, ',' ORDER BY pos) AS target_codes, count(*) > 1 AS is_ambiguous FROM corr GROUP BY code08"),
    "sql_over_frames": q(
        "SELECT apet_finale AS code08, count(*) AS n_rows FROM extraction e WHERE EXISTS "
        "(SELECT 1 FROM ground_truth g WHERE g.liasse_numero = e.liasse_numero) GROUP BY apet_finale"),
    "metrics_written": q(
        f"coded AS ({coded_long('pred_a')})",
        "SELECT metric, value, 'r1' AS run_id, 'org--model-1.5' AS model, cast(2 as integer) AS shard FROM coded"),
    "ensemble_named_models": q(WIDE, f"SELECT liasse_numero, {VOTE} AS label FROM wide"),
    "assemble_unique": q(
        *_assemble_ctes(),
        f"model_one AS (SELECT * FROM model_full QUALIFY row_number() OVER (PARTITION BY {attrs()} "
        f"ORDER BY liasse_numero ASC NULLS FIRST, nace2025 ASC NULLS FIRST) = 1)",
        f"model_reach AS (SELECT t.liasse_numero, m.nace2025, {attrs('m.')} FROM model_one m JOIN targets t ON "
        + " AND ".join(f"m.{a} IS NOT DISTINCT FROM t.{a}" for a in ATTRS) + " WHERE t.liasse_numero IS NOT NULL)",
        "SELECT * FROM univ_full UNION ALL SELECT * FROM human_prop UNION ALL "
        "SELECT * FROM model_reach m WHERE NOT EXISTS (SELECT 1 FROM human_prop h WHERE h.liasse_numero = m.liasse_numero)"),
    "metrics_long": q(
        CAND, *EVAL_ANNOTATED,
        f"acc AS ({_accuracy_long('ev')})",
        "coded AS (SELECT metric, value FROM (UNPIVOT (SELECT cast(count_if(codable) as double) AS num_coded, "
        "cast(count(*) - count_if(codable) as double) AS num_not_coded, "
        "round_even((count(*) - count_if(codable)) * cast(100 as double) / count(*), 2) AS pct_not_coded FROM pred_a) "
        "ON COLUMNS(*) INTO NAME metric VALUE value))",
        "SELECT * FROM acc UNION ALL SELECT * FROM coded"),
}
