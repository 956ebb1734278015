"""The SQL each registered query must equal. Written set by set for an RE2-based engine."""

from __future__ import annotations

from catalog import queries as Q
from kindred import constants as K


def text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def values(names) -> str:
    return ", ".join(text(n) for n in names)


SPACE = r"[\t-\r\x1c-\x1f\x{85}\p{Z}]"


# ------------------------------------------------------------------ stand-ins

FACETS = """
facets AS (
  SELECT o_orderkey AS item_id, o_totalprice AS calories, o_orderstatus AS meal,
         o_orderpriority AS cooking_methods, dayofyear(o_orderdate)::INT AS time_mins,
         protein, fat, carbs, course,
         coalesce(vegetables, 0) AS vegetables, coalesce(fruits, 0) AS fruits,
         coalesce(meat, 0) AS meat, coalesce(seafood, 0) AS seafood,
         coalesce(mushrooms, 0) AS mushrooms, coalesce(dairy, 0) AS dairy,
         coalesce(grains, 0) AS grains, coalesce(nuts, 0) AS nuts
  FROM orders LEFT JOIN (
    SELECT l_orderkey, count(*) * 5.0::DOUBLE AS protein, max(l_quantity) AS fat,
           max(l_discount) * 1000 AS carbs, max(l_linestatus) AS course,
           max((l_returnflag = 'A')::INT) AS vegetables, max((l_returnflag = 'N')::INT) AS fruits,
           max((l_returnflag = 'R')::INT) AS meat, max((l_linestatus = 'O')::INT) AS seafood,
           max((l_tax = 0)::INT) AS mushrooms, max((l_discount = 0)::INT) AS dairy,
           max((l_quantity < 5)::INT) AS grains, max((l_quantity > 45)::INT) AS nuts
    FROM lineitem GROUP BY l_orderkey) l ON o_orderkey = l_orderkey)
"""
VECTORS = """
vectors AS (
  SELECT vec_id AS item_id, embedding::DOUBLE[] AS v, label,
         (embedding[1] > 0)::INT AS first_sign,
         CASE WHEN embedding[2] > 0 THEN 'up' ELSE 'down' END AS second_sign
  FROM embeddings)
"""
PART_CATEGORIES = "p_type || ' Recipes,  ' || p_name || ' and ' || p_brand"
SIZE_AS_TIME = """CASE WHEN p_size < 10 THEN (p_size + 5)::VARCHAR || ' mins'
  ELSE (p_size // 10)::VARCHAR || CASE WHEN p_size // 10 = 1 THEN ' hr ' ELSE ' hrs ' END
       || (p_size + 5)::VARCHAR || ' mins' END"""
MINUTES = "CASE WHEN p_size >= 10 AND p_size + 5 <= 59 THEN p_size // 10 * 60 + p_size + 5 END"

FILTER_WHERE = """cooking_methods IN ('1-URGENT', '3-MEDIUM') AND seafood = 0 AND nuts = 0
  AND calories BETWEEN 1000 AND 300000 AND protein BETWEEN 0 AND 40
  AND fat BETWEEN 0 AND 50 AND carbs BETWEEN 0 AND 100 AND time_mins <= 300"""
OPEN_WHERE = "calories BETWEEN 1000 AND 400000"


def best(k: int, score: str = "score", partition: str = "query_id") -> str:
    return f"row_number() OVER (PARTITION BY {partition} ORDER BY round({score}, 9) DESC, item_id)"


# ------------------------------------------------------------------ words


def singular(w: str) -> str:
    cases = " ".join(f"WHEN {text(a)} THEN {w}[1] || {text(b[1:])}" for a, b in K.NOUN_EXCEPTIONS.items())
    return f"""CASE lower({w}) {cases} ELSE
      CASE WHEN regexp_matches({w}, '(?i)[^aeiou]ies$') THEN regexp_replace({w}, '(?i)ies$', 'y')
           WHEN regexp_matches({w}, '(?i)(ch|sh|ss|x|zz|o)es$') THEN regexp_replace({w}, '(?i)es$', '')
           WHEN regexp_matches({w}, '(?i)(ss|us|is)$') THEN {w}
           WHEN regexp_matches({w}, '(?i)..s$') THEN regexp_replace({w}, '(?i)s$', '')
           ELSE {w} END END"""


def token_text(column: str) -> str:
    """Separators become blanks, one rule after the other (no look-ahead here)."""
    rules = [
        (r"([:,])([^\p{Nd}])", r" \2"), (r"([:,])([^\p{Nd}])", r" \2"), (r"[:,]\z", " "),
        (r"\.\.\.", " "), (r"[;@#$%&?!\[\](){}<>\"“”«»…]", " "), (r"--", " "),
        (rf"\.+['’]*({SPACE}|\z)", " "), (rf"n't({SPACE}|\z)", " "),
        (rf"'(s|m|d|ll|re|ve)?({SPACE}|\z)", " "),
    ]
    out = f"lower({column})"
    for pattern, instead in rules:
        out = f"regexp_replace({out}, {text(pattern)}, {text(instead)}, 'g')"
    return out


def words_of(source: str, key: str, column: str, name: str) -> str:
    """CTE ``name`` (key, word): the distinct kept words of a text column."""
    return f"""{name} AS (
      SELECT DISTINCT {key}, {singular('w')} AS word FROM (
        SELECT DISTINCT {key}, unnest(regexp_split_to_array({token_text(column)}, '{SPACE}+')) AS w FROM {source})
      WHERE regexp_matches(w, '^[\\p{{L}}\\p{{N}}]+$') AND NOT regexp_matches(w, '^\\p{{Nd}}+$')
        AND w NOT IN ({values(K.STOP_WORDS)}))"""


def overlap_topk(items: str, queries: str, fields: list[tuple[str, str]], k: int, extra: str = "") -> str:
    """CTEs ending in ``overlap`` (query_id, rank, item_id, score), zero scores included."""
    parts, unions = [], []
    for i, (item_column, query_column) in enumerate(fields):
        parts.append(words_of(items, "item_id", item_column, f"iw{i}"))
        parts.append(words_of(queries, "query_id", query_column, f"qw{i}"))
        unions.append(f"SELECT query_id, item_id FROM qw{i} JOIN iw{i} USING (word)")
    return ",\n".join(parts) + f""",
    shared AS (SELECT query_id, item_id, count(*) AS n FROM ({' UNION ALL '.join(unions)}) GROUP BY ALL),
    overlap AS (
      SELECT * FROM (
        SELECT query_id, {best(k, "score")}::INT AS rank, item_id, score FROM (
          SELECT q.query_id, i.item_id, coalesce(n, 0)::BIGINT AS score
          FROM (SELECT query_id FROM {queries}) q CROSS JOIN (SELECT item_id FROM {items}) i
          LEFT JOIN shared s ON s.query_id = q.query_id AND s.item_id = i.item_id))
      WHERE rank <= {k})"""


# ------------------------------------------------------------------ n-grams


def word_grams(source: str, key: str, column: str, name: str) -> str:
    """CTE ``name`` (key, term, tf) of word 1-2-grams."""
    return f"""{name}_w AS MATERIALIZED (
      SELECT {key}, w, lead(w) OVER (PARTITION BY {key} ORDER BY pos) AS next FROM (
        SELECT {key}, unnest(ws) AS w, unnest(range(len(ws))) AS pos FROM (
          SELECT {key}, regexp_extract_all(lower({column}), '[\\p{{L}}\\p{{N}}_]{{2,}}') AS ws FROM {source}))
      WHERE w NOT IN ({values(K.STOP_WORDS)})),
    {name} AS MATERIALIZED (
      SELECT {key}, term, count(*) AS tf FROM (
        SELECT {key}, w AS term FROM {name}_w UNION ALL
        SELECT {key}, w || ' ' || next FROM {name}_w WHERE next IS NOT NULL) GROUP BY ALL)"""


def char_grams(source: str, key: str, column: str, name: str) -> str:
    """CTE ``name`` (key, term, tf) of character 2-4-grams."""
    return f"""{name}_c AS MATERIALIZED (
      SELECT {key}, c, lead(c, 1) OVER w AS c1, lead(c, 2) OVER w AS c2, lead(c, 3) OVER w AS c3 FROM (
        SELECT {key}, unnest(cs) AS c, unnest(range(len(cs))) AS pos FROM (
          SELECT {key}, regexp_extract_all(
            regexp_replace(lower({column}), '{SPACE}{{2,}}', ' ', 'g'), '(?s).') AS cs FROM {source}))
      WINDOW w AS (PARTITION BY {key} ORDER BY pos)),
    {name} AS MATERIALIZED (
      SELECT {key}, term, count(*) AS tf FROM (
        SELECT {key}, c || c1 AS term FROM {name}_c WHERE c1 IS NOT NULL UNION ALL
        SELECT {key}, c || c1 || c2 FROM {name}_c WHERE c2 IS NOT NULL UNION ALL
        SELECT {key}, c || c1 || c2 || c3 FROM {name}_c WHERE c3 IS NOT NULL) GROUP BY ALL)"""


def tfidf_topk(items: str, queries: str, item_text: str, query_text: str, k: int) -> str:
    """CTEs ending in ``tfidf`` (query_id, rank, item_id, score)."""
    def unit(block: str, key: str) -> str:
        return f"""
    {block}{key[0]}u AS MATERIALIZED (
      SELECT {key}, term, w / sqrt(sum(w * w) OVER (PARTITION BY {key})) AS w FROM (
        SELECT {key}, term, tf * idf AS w FROM {block}{key[0]} JOIN {block}v USING (term)))"""

    return f"""
    n AS (SELECT count(*) AS n FROM {items}),
    it AS MATERIALIZED (SELECT item_id, {item_text} AS t FROM {items}),
    qt AS MATERIALIZED (SELECT query_id, {query_text} AS t FROM {queries}),
    {word_grams('it', 'item_id', 't', 'wi')}, {word_grams('qt', 'query_id', 't', 'wq')},
    {char_grams('it', 'item_id', 't', 'ci')}, {char_grams('qt', 'query_id', 't', 'cq')},
    wv AS MATERIALIZED (
      SELECT term, ln((1 + n) / (1 + df)::DOUBLE) + 1 AS idf
      FROM (SELECT term, count(*) AS df FROM wi GROUP BY term), n WHERE df <= 0.8::DOUBLE * n),
    cv AS MATERIALIZED (
      SELECT term, ln((1 + n) / (1 + df)::DOUBLE) + 1 AS idf
      FROM (SELECT term, count(*) AS df, sum(tf) AS cf FROM ci GROUP BY term), n
      WHERE df <= 0.8::DOUBLE * n ORDER BY cf DESC, term LIMIT 5000),
    {unit('w', 'item_id')}, {unit('w', 'query_id')}, {unit('c', 'item_id')}, {unit('c', 'query_id')},
    nb AS (SELECT item_id, count(*) AS b FROM (
      SELECT DISTINCT item_id, 'w' FROM wiu UNION ALL SELECT DISTINCT item_id, 'c' FROM ciu) GROUP BY item_id),
    qb AS (SELECT query_id, count(*) AS b FROM (
      SELECT DISTINCT query_id, 'w' FROM wqu UNION ALL SELECT DISTINCT query_id, 'c' FROM cqu) GROUP BY query_id),
    dots AS (SELECT query_id, item_id, sum(p) AS dot FROM (
      SELECT query_id, item_id, wqu.w * wiu.w AS p FROM wqu JOIN wiu USING (term) UNION ALL
      SELECT query_id, item_id, cqu.w * ciu.w FROM cqu JOIN ciu USING (term)) GROUP BY ALL),
    tfidf AS (
      SELECT * FROM (
        SELECT query_id, {best(k)}::INT AS rank, item_id, score FROM (
          SELECT qt.query_id, it.item_id, coalesce(dot / sqrt(qb.b) / sqrt(nb.b), 0) AS score
          FROM qt CROSS JOIN it LEFT JOIN dots ON dots.query_id = qt.query_id AND dots.item_id = it.item_id
          LEFT JOIN nb ON nb.item_id = it.item_id LEFT JOIN qb ON qb.query_id = qt.query_id))
      WHERE rank <= {k})"""


# ------------------------------------------------------------------ vectors

PAIRS = f"""{VECTORS},
pairs AS MATERIALIZED (
  SELECT q.item_id AS query_id, i.item_id, list_cosine_similarity(q.v, i.v) AS sim,
         ((q.label = i.label)::INT + (q.first_sign = i.first_sign)::INT
          + (q.second_sign = i.second_sign)::INT) AS matches
  FROM vectors q CROSS JOIN vectors i)"""


def ranked(source: str, score: str, name: str, k: int, where: str = "true") -> str:
    return f"""{name} AS (
      SELECT query_id, rank, item_id, score FROM (
        SELECT query_id, {best(k, score)}::INT AS rank, item_id, {score} AS score FROM {source} WHERE {where})
      WHERE rank <= {k})"""


def blended(low: float, high: float, k: int) -> str:
    return f"""{PAIRS},
    {ranked('pairs', '0.6::DOUBLE * sim + (1 - 0.6::DOUBLE) * matches / 3', 'main', k, f'sim >= {low}::DOUBLE AND sim <= {high}::DOUBLE')},
    {ranked('pairs', 'sim', 'fb', k)},
    full_band AS (SELECT query_id FROM main GROUP BY query_id HAVING count(*) = {k}),
    blended AS (
      SELECT *, 'band' AS branch FROM main WHERE query_id IN (FROM full_band) UNION ALL
      SELECT *, 'fallback' FROM fb WHERE query_id NOT IN (FROM full_band))"""


DEMOTED = "CASE WHEN sim > 0.98 THEN -1.0::DOUBLE ELSE sim END"
RESTRICTED = f"{PAIRS}, {ranked('pairs', DEMOTED, 'restricted', 10)}"
VECTOR_GOLDEN = """golden AS (
  SELECT vec_id AS query_id, unnest([vec_id + 1, vec_id + 2]) AS relevant_id FROM embeddings)"""
BOTH_METHODS = f"""{blended(*Q.BAND, 10)}, {ranked('pairs', DEMOTED, 'restricted', 10)},
  found AS (SELECT 'restricted' AS method, query_id, rank, item_id FROM restricted UNION ALL
            SELECT 'blended', query_id, rank, item_id FROM blended), {VECTOR_GOLDEN}"""


def report(methods: list[str]) -> str:
    rows = ", ".join(f"({text(m)})" for m in methods)
    return f"""
    SELECT m.method, count(f.item_id)::BIGINT AS hits, any_value(g.n)::BIGINT AS max_hits,
           round(count(f.item_id) * 100.0::DOUBLE / any_value(g.n), 6) AS hit_pct
    FROM (VALUES {rows}) m(method)
    CROSS JOIN (SELECT count(DISTINCT (query_id, relevant_id)) AS n FROM golden) g
    LEFT JOIN (SELECT DISTINCT method, f.query_id, f.item_id FROM found f
               JOIN golden g ON f.query_id = g.query_id AND f.item_id = g.relevant_id) f ON f.method = m.method
    GROUP BY m.method"""


def encoder(source: str, key: str, column: str, name: str) -> str:
    """CTE ``name`` (key, slot, value): the hashing encoder, zero slots left out."""
    return f"""{name}_t AS (
      SELECT {key}, md5(w) AS h FROM (
        SELECT {key}, unnest(regexp_extract_all(lower({column}), '[\\p{{L}}\\p{{N}}]+')) AS w FROM {source})),
    {name}_s AS (
      SELECT {key}, (('0x' || h[1:8])::BIGINT % 64)::INT AS slot,
             sum(CASE WHEN h[9:9] IN ('0','1','2','3','4','5','6','7') THEN 1 ELSE -1 END)::DOUBLE AS x
      FROM {name}_t GROUP BY ALL),
    {name} AS (
      SELECT {key}, slot, (x / nullif(sqrt(sum(x * x) OVER (PARTITION BY {key})), 0)) AS value FROM {name}_s)"""


def lexicon(source: str, key: str, column: str, lexicon: dict[str, list[str]], name: str) -> str:
    """CTE ``name`` (key, label, score): the lexicon classifier's best label."""
    entries = ", ".join(
        f"({i}, {text(label)}, {text(word)})" for i, (label, ws) in enumerate(lexicon.items()) for word in ws
    )
    first = text(next(iter(lexicon)))
    return f"""{name}_h AS (
      SELECT {key}, place, label, count(*) AS hits FROM (
        SELECT {key}, unnest(regexp_extract_all(lower({column}), '[\\p{{L}}\\p{{N}}]+')) AS word FROM {source})
      JOIN (VALUES {entries}) lex(place, label, word) USING (word) GROUP BY ALL),
    {name}_b AS (
      SELECT {key}, first(label ORDER BY hits DESC, place) AS label, max(hits) / sum(hits)::DOUBLE AS score
      FROM {name}_h GROUP BY {key}),
    {name} AS (
      SELECT s.{key}, coalesce(b.label, {first}) AS label, coalesce(b.score, 1.0::DOUBLE / {len(lexicon)}) AS score
      FROM {source} s LEFT JOIN {name}_b b ON b.{key} = s.{key})"""


# ------------------------------------------------------------------ categories


def normalized(source: str, key: str, column: str, name: str) -> str:
    """CTE ``name`` (key, cat): distinct singular category names."""
    return f"""{name}_p AS (
      SELECT {key}, pos, trim(replace(part, 'Recipes', '')) AS part FROM (
        SELECT {key}, unnest(ps) AS part, unnest(range(len(ps))) AS pos FROM (
          SELECT {key}, string_split_regex(trim(regexp_replace({column}, '{SPACE}+', ' ', 'g')), ' *, *| +and +') AS ps
          FROM {source}))),
    {name}_w AS (
      SELECT {key}, pos, unnest(ws) AS w, unnest(range(len(ws))) AS word_at FROM (
        SELECT {key}, pos, string_split_regex(part, ' +') AS ws FROM {name}_p WHERE part <> '')),
    {name} AS (
      SELECT DISTINCT {key}, cat FROM (
        SELECT {key}, pos, string_agg({singular('w')}, ' ' ORDER BY word_at) AS cat FROM {name}_w GROUP BY {key}, pos))"""


def uncombined(source: str, key: str, name: str) -> str:
    """CTE ``name``: the categories that are not two other ones side by side."""
    return f"""{name} AS (
      SELECT {key}, cat FROM {source} c WHERE NOT EXISTS (
        SELECT 1 FROM {source} a JOIN {source} b ON a.{key} = b.{key} AND a.cat <> b.cat
        WHERE a.{key} = c.{key} AND c.cat = a.cat || ' ' || b.cat))"""


def vocabulary_split(source: str, key: str, vocabulary: list[str], name: str) -> str:
    """CTE ``name`` (key, parts): pieces joined in order."""
    pattern = r"\b(?:" + "|".join(vocabulary) + r")\b"
    return f"""{name}_x AS (
      SELECT {key}, unnest(CASE WHEN len(regexp_extract_all(cat, '{pattern}')) = 0 THEN [cat] ELSE
        list_concat(regexp_extract_all(cat, '{pattern}'),
          list_filter(list_transform(string_split_regex(cat, '{pattern}'), lambda p: trim(p)), lambda p: p <> '')) END) AS part
      FROM {source}),
    {name} AS (
      SELECT {key}, string_agg(part, ', ' ORDER BY part) AS parts FROM (SELECT DISTINCT {key}, part FROM {name}_x)
      GROUP BY {key})"""


# ------------------------------------------------------------------ feature build

RAW = f"""
raw AS (
  SELECT p_partkey AS item_id,
    upper(p_type[1]) || lower(p_type[2:]) || ' Recipes, ' || CASE
      WHEN contains(p_name, 'gear') THEN 'Main Dishes' WHEN contains(p_name, 'bolt') THEN 'Healthy Soup Recipes'
      WHEN contains(p_name, 'ring') THEN 'Vegan and Apple Pies Dessert'
      WHEN contains(p_name, 'rod') THEN 'Dinner Salad' ELSE 'Cookies' END AS categories,
    p_retailprice AS calories, p_size::DOUBLE AS fat, p_size::DOUBLE AS carbs, p_size::DOUBLE AS protein,
    ({MINUTES})::INT AS time_mins,
    CASE WHEN contains(p_name, 'hot') THEN 'Preheat oven and bake, then grill'
         WHEN contains(p_name, 'cold') THEN 'Chill in the freezer' ELSE 'Fry in a skillet' END AS directions,
    concat_ws(',  ', 'salt', CASE WHEN p_size > 25 THEN '2 cups flour' END,
      CASE WHEN contains(p_name, 'red') THEN '1 tomato' END,
      CASE WHEN contains(p_name, 'blue') THEN 'fish fillet' END, 'apple ' || p_brand) AS ingr
  FROM part)"""


def first_of(column: str, names: list[str]) -> str:
    whens = " ".join(f"WHEN contains({column}, {text(n)}) THEN {text(n)}" for n in names)
    return f"CASE {whens} ELSE 'None' END"


INGREDIENT_FLAGS = f"""
lines AS (SELECT item_id, unnest(string_split(ingr, ',  ')) AS line FROM raw),
line AS (SELECT DISTINCT line FROM lines),
{lexicon('line', 'line', 'line', K.INGREDIENT_LEXICON, 'grp')},
flags AS (
  SELECT item_id, {', '.join(f"max((label = {text(g)} AND score > 0.6::DOUBLE)::INT) AS {g.lower()}" for g in K.INGREDIENT_GROUPS)}
  FROM lines JOIN grp USING (line) GROUP BY item_id)"""
BUILT = f"""{RAW}, {INGREDIENT_FLAGS},
{normalized('raw', 'item_id', 'categories', 'names')}, {uncombined('names', 'item_id', 'kept')},
{vocabulary_split('kept', 'item_id', K.CATEGORIES, 'cats')},
{lexicon('raw', 'item_id', 'directions', K.COOKING_LEXICON, 'method')},
built AS (
  SELECT item_id, calories, protein, fat, carbs, {first_of('parts', K.MEALS)} AS meal,
         {first_of('parts', K.COURSES)} AS course, contains(parts, 'Healthy')::INT AS healthy,
         {first_of('parts', K.DIETS)} AS special_nutrition, method.label AS cooking_methods, time_mins,
         {', '.join(K.FLAG_COLUMNS)}
  FROM raw JOIN cats USING (item_id) JOIN method USING (item_id) JOIN flags USING (item_id))"""


def code(column: str) -> str:
    return f"(dense_rank() OVER (ORDER BY {column}) - 1)::INT AS {column}"


# ------------------------------------------------------------------ all

DOCS = """
docs AS (SELECT doc_id AS item_id, text AS directions, lang || ' ' || source AS ingr FROM documents),
asked AS (SELECT item_id AS query_id, text AS directions, 'en src1' AS ingredients FROM benchmark)"""
TURNS = """
turns AS (SELECT conv_id * 1000 + turn AS item_id, text AS directions, role AS ingr FROM conversations),
golden AS (SELECT conv_id * 1000 + turn AS query_id, conv_id * 1000 + turn + 1 AS relevant_id
           FROM conversations WHERE role = 'user'),
asked AS (SELECT item_id AS query_id, directions, ingr AS ingredients FROM turns
          WHERE item_id IN (SELECT query_id FROM golden))"""
TURN_VECTORS = f"""
{encoder('turns', 'item_id', 'directions', 'ed')}, {encoder('turns', 'item_id', 'ingr', 'ei')},
slots AS (
  SELECT item_id, slot, value FROM ed UNION ALL SELECT item_id, slot + 64, value FROM ei),
tv AS MATERIALIZED (
  SELECT item_id, list(coalesce(value, 0)::FLOAT::DOUBLE ORDER BY slot) AS v FROM (
    SELECT t.item_id, s.slot, slots.value FROM turns t CROSS JOIN (SELECT unnest(range(128))::INT AS slot) s
    LEFT JOIN slots ON slots.item_id = t.item_id AND slots.slot = s.slot) GROUP BY item_id),
turn_pairs AS MATERIALIZED (
  SELECT q.item_id AS query_id, i.item_id, coalesce(list_cosine_similarity(q.v, i.v), 0) AS sim,
         (turns.ingr = 'assistant')::INT AS matches
  FROM tv q JOIN asked ON q.item_id = asked.query_id CROSS JOIN tv i JOIN turns ON turns.item_id = i.item_id)"""
METHODS = ["words", "tfidf", "embedding", "blended"]

ORACLE: dict[str, str] = {
    "facet_filter": f"WITH {FACETS} SELECT item_id FROM facets WHERE {FILTER_WHERE}",
    "facet_gate": f"""WITH {FACETS} SELECT meal, count(*) FILTER (WHERE {FILTER_WHERE}) AS candidates,
        CASE WHEN count(*) FILTER (WHERE {FILTER_WHERE}) < 100 THEN 'too_few_candidates' ELSE 'ok' END AS status
        FROM facets GROUP BY meal""",
    "facet_match": f"""WITH {VECTORS} SELECT item_id, (label = 3)::INT + (first_sign = 1)::INT
        + (second_sign = 'up')::INT AS matches FROM vectors""",
    "multi_hot": """SELECT l_orderkey, max((l_returnflag = 'A')::INT) AS a, max((l_returnflag = 'N')::INT) AS n,
        max((l_returnflag = 'R')::INT) AS r, max((l_returnflag = 'X')::INT) AS x FROM lineitem GROUP BY l_orderkey""",
    "multi_hot_array": "SELECT p_partkey, " + ", ".join(
        f"list_contains(string_split(p_name, ' '), {text(c)})::INT AS {c}" for c in Q.COLOURS) + " FROM part",
    "label_encode": f"SELECT o_orderkey, {code('o_orderpriority')}, {code('o_orderstatus')} FROM orders",
    "label_dictionary": """SELECT "column", label, n, (row_number() OVER (PARTITION BY "column" ORDER BY label) - 1)::INT AS code
        FROM (SELECT 'o_orderpriority' AS "column", o_orderpriority AS label, count(*) AS n FROM orders GROUP BY ALL
              UNION ALL SELECT 'o_orderstatus', o_orderstatus, count(*) FROM orders GROUP BY ALL)""",
    "max_minutes": "SELECT p_partkey, (p_size // 10 * 60 + p_size)::BIGINT AS minutes FROM part",
    "first_category": f"SELECT p_partkey, {first_of('p_name', Q.COLOURS)} AS category FROM part",
    "contains_flag": "SELECT doc_id, contains(text, 'the')::INT AS flag FROM documents",
    "normalize_categories": f"""WITH s AS (SELECT p_partkey, {PART_CATEGORIES} AS c FROM part),
        {normalized('s', 'p_partkey', 'c', 'names')}
        SELECT p_partkey, string_agg(cat, ',' ORDER BY cat) AS categories FROM names GROUP BY p_partkey""",
    "drop_combined": f"""WITH s AS (
        SELECT DISTINCT p_partkey, unnest(list_concat(string_split(p_name, ' '),
          [p_name, lower(p_type), p_name || ' ' || lower(p_type)])) AS cat FROM part),
        {uncombined('s', 'p_partkey', 'kept')}
        SELECT p_partkey, string_agg(cat, ',' ORDER BY cat) AS kept FROM kept GROUP BY p_partkey""",
    "vocab_split": f"""WITH s AS (SELECT p_partkey, unnest([{PART_CATEGORIES}, p_name]) AS cat FROM part),
        {vocabulary_split('s', 'p_partkey', Q.WORD_VOCABULARY, 'cut')} SELECT p_partkey, parts FROM cut""",
    "clean_categories": f"""WITH s AS (SELECT p_partkey, {PART_CATEGORIES} AS c FROM part),
        {normalized('s', 'p_partkey', 'c', 'names')}, {uncombined('names', 'p_partkey', 'kept')},
        {vocabulary_split('kept', 'p_partkey', Q.CLEAN_VOCABULARY, 'cut')}
        SELECT p_partkey, parts AS categories FROM cut""",
    "time_to_minutes": f"SELECT p_partkey, {SIZE_AS_TIME} AS total_time, ({MINUTES})::INT AS minutes FROM part",
    "unreadable_times": f"""SELECT p_brand, count(*) FILTER (WHERE t IS NOT NULL AND m IS NULL) AS unreadable, count(*) AS n
        FROM (SELECT p_brand, {SIZE_AS_TIME} AS t, {MINUTES} AS m FROM part) GROUP BY p_brand""",
    "line_split": """SELECT doc_id, unnest(range(len(ls)))::INT AS pos, unnest(ls) AS line
        FROM (SELECT doc_id, string_split(replace(text, '. ', ',  '), ',  ') AS ls FROM documents)""",
    "unique_words": f"""WITH {words_of('documents', 'doc_id', 'text', 'ws')}
        SELECT d.doc_id, count(word)::INT AS n, coalesce(string_agg(word, ',' ORDER BY word), '') AS words
        FROM documents d LEFT JOIN ws ON ws.doc_id = d.doc_id GROUP BY d.doc_id""",
    "word_overlap": f"""WITH s AS (SELECT p_partkey, p_name AS a, p_type || ' red old rods' AS b FROM part),
        {words_of('s', 'p_partkey', 'a', 'wa')}, {words_of('s', 'p_partkey', 'b', 'wb')}
        SELECT s.p_partkey, count(word)::INT AS shared FROM s
        LEFT JOIN (SELECT p_partkey, word FROM wa JOIN wb USING (p_partkey, word)) x ON x.p_partkey = s.p_partkey
        GROUP BY s.p_partkey""",
    "array_roundtrip": f"""WITH {words_of('documents', 'doc_id', 'text', 'ws')}
        SELECT d.doc_id, count(word)::INT AS n, 1 AS same
        FROM documents d LEFT JOIN ws ON ws.doc_id = d.doc_id GROUP BY d.doc_id""",
    "golden_explode": """SELECT conv_id * 1000 + turn AS query_id, unnest([conv_id * 1000 + turn + 1, conv_id * 1000 + turn])
        AS relevant_id FROM conversations WHERE role = 'user'""",
    "word_overlap_topk": f"""WITH {DOCS}, {overlap_topk('docs', 'asked', [('directions', 'directions'), ('ingr', 'ingredients')], 10)}
        SELECT * FROM overlap""",
    "word_ngrams": f"""WITH {word_grams('documents', 'doc_id', 'text', 'g')}
        SELECT term, count(*) AS df, sum(tf)::BIGINT AS cf FROM g GROUP BY term""",
    "char_ngrams": f"""WITH {char_grams('documents', 'doc_id', 'text', 'g')}
        SELECT term, count(*) AS df, sum(tf)::BIGINT AS cf FROM g GROUP BY term""",
    "term_frequency": f"""WITH {word_grams('documents', 'doc_id', 'text', 'g')}
        SELECT doc_id AS item_id, term, tf FROM g""",
    "tfidf_vocab": f"""WITH {char_grams('documents', 'doc_id', 'text', 'g')}, n AS (SELECT count(*) AS n FROM documents)
        SELECT term, df, cf, round(ln((1 + n) / (1 + df)::DOUBLE) + 1, 6) AS idf
        FROM (SELECT term, count(*) AS df, sum(tf)::BIGINT AS cf FROM g GROUP BY term), n
        WHERE df <= 0.8::DOUBLE * n ORDER BY cf DESC, term LIMIT 5000""",
    "tfidf_idf": f"""WITH {word_grams('documents', 'doc_id', 'text', 'g')}, n AS (SELECT count(*) AS n FROM documents)
        SELECT term, df, round(ln((1 + n) / (1 + df)::DOUBLE) + 1, 6) AS idf
        FROM (SELECT term, count(*) AS df FROM g GROUP BY term), n WHERE df <= 0.8::DOUBLE * n""",
    "tfidf_norms": f"""WITH {word_grams('documents', 'doc_id', 'text', 'g')}, {char_grams('documents', 'doc_id', 'text', 'h')},
        n AS (SELECT count(*) AS n FROM documents),
        v AS (SELECT term, ln((1 + n) / (1 + df)::DOUBLE) + 1 AS idf
              FROM (SELECT term, count(*) AS df FROM g GROUP BY term), n WHERE df <= 0.8::DOUBLE * n),
        u AS (SELECT term, ln((1 + n) / (1 + df)::DOUBLE) + 1 AS idf
              FROM (SELECT term, count(*) AS df, sum(tf) AS cf FROM h GROUP BY term), n
              WHERE df <= 0.8::DOUBLE * n ORDER BY cf DESC, term LIMIT 5000),
        a AS (SELECT doc_id, sqrt(sum(tf * idf * tf * idf)) AS x FROM g JOIN v USING (term) GROUP BY doc_id),
        b AS (SELECT doc_id, sqrt(sum(tf * idf * tf * idf)) AS x FROM h JOIN u USING (term) GROUP BY doc_id)
        SELECT d.doc_id AS item_id, round(coalesce(a.x, 0), 6) AS word, round(coalesce(b.x, 0), 6) AS char
        FROM documents d LEFT JOIN a USING (doc_id) LEFT JOIN b USING (doc_id)""",
    "tfidf_topk": f"""WITH {DOCS}, {tfidf_topk('docs', 'asked', "directions || ' ' || ingr", "directions || '. ' || ingredients", 10)}
        SELECT query_id, rank, item_id, round(score, 6) AS score FROM tfidf""",
    "cosine_pairs": f"""WITH {VECTORS}, s AS (
          SELECT item_id, list_cosine_similarity(v, list_concat(v[1:32], v[1:32])) AS sim,
                 (label = 3)::INT + (first_sign = 1)::INT + (second_sign = 'up')::INT AS matches FROM vectors)
        SELECT item_id, round(sim, 6) AS similarity,
               round(CASE WHEN sim > 0.7 THEN -1.0::DOUBLE ELSE sim END, 6) AS demoted,
               round(0.6::DOUBLE * sim + (1 - 0.6::DOUBLE) * matches / 3, 6) AS blended FROM s""",
    "vector_topk": f"""WITH {PAIRS}, {ranked('pairs', 'sim', 'top', 10)}
        SELECT query_id, rank, item_id, round(score, 6) AS score FROM top""",
    "vector_topk_filtered": f"""WITH {PAIRS}, {FACETS},
        {ranked('pairs', DEMOTED, 'top', 10, f'item_id IN (SELECT item_id FROM facets WHERE {OPEN_WHERE})')}
        SELECT query_id, rank, item_id, round(score, 6) AS score FROM top""",
    "blend_topk": f"""WITH {blended(*Q.BAND, 10)}
        SELECT query_id, rank, item_id, round(score, 6) AS score, branch FROM blended""",
    "blend_fallback": f"""WITH {blended(0.8, 0.95, 10)}
        SELECT query_id, rank, item_id, round(score, 6) AS score, branch FROM blended""",
    "result_lookup": f"""WITH items AS (SELECT page_id AS item_id, html AS directions FROM pages),
        asked AS (SELECT item_id AS query_id, text AS directions FROM benchmark),
        {overlap_topk('items', 'asked', [('directions', 'directions')], 5)}
        SELECT item_id, url, query_id, rank, score FROM overlap JOIN pages ON page_id = item_id""",
    "csv_roundtrip": """SELECT doc_id AS item_id, text AS directions, lang AS ingr, lang || '/' || source AS url
        FROM documents""",
    "csv_line_ids": """SELECT row_number() OVER (ORDER BY doc_id) - 1 AS item_id, text AS directions, lang AS ingr,
        source AS url FROM documents""",
    "token_store": f"""WITH {TURNS},
        {overlap_topk('turns', 'asked', [('directions', 'directions'), ('ingr', 'ingredients')], 5)}
        SELECT * FROM overlap""",
    "vector_store": f"""WITH {PAIRS}, {ranked('pairs', DEMOTED, 'top', 3)}
        SELECT query_id, rank, item_id, round(score, 6) AS score FROM top""",
    "tfidf_store": f"""WITH {TURNS},
        {tfidf_topk('turns', 'asked', "directions || ' ' || ingr", "directions || '. ' || ingredients", 5)}
        SELECT query_id, rank, item_id, round(score, 6) AS score FROM tfidf""",
    "lemma_table": f"""WITH w AS (
          SELECT DISTINCT p_partkey, unnest(string_split(p_name || ' ' || lower(p_type), ' ')) AS word FROM part),
        l AS (SELECT DISTINCT unnest(string_split(p_name, ' ')) AS surface FROM part)
        SELECT p_partkey AS item_id, string_agg(DISTINCT lemma, ',' ORDER BY lemma) AS words FROM (
          SELECT p_partkey, CASE WHEN surface IS NULL THEN word ELSE regexp_replace(word, '(ing|ed|er|s)$', '') END AS lemma
          FROM w LEFT JOIN l ON surface = word) GROUP BY p_partkey""",
    "ingredient_labels": f"""WITH {RAW},
        lines AS (SELECT item_id, unnest(string_split(ingr, ',  ')) AS line FROM raw),
        line AS (SELECT line, count(*) AS n FROM lines GROUP BY line),
        {lexicon('line', 'line', 'line', K.INGREDIENT_LEXICON, 'grp')}
        SELECT line, n, CASE WHEN score > 0.6::DOUBLE THEN label END AS grp FROM line JOIN grp USING (line)""",
    "evaluation_facets": f"""WITH {FACETS} SELECT item_id, meal, coalesce(nullif(course, 'F'), '0') AS course,
        cooking_methods, {', '.join(K.FLAG_COLUMNS)} FROM facets""",
    "query_guard": "SELECT o_orderkey AS query_id FROM orders WHERE o_orderstatus = 'O'",
    "encode_concat": f"""WITH d AS (SELECT doc_id, text, lang || ' ' || source AS t FROM documents),
        {encoder('d', 'doc_id', 'text', 'a')}, {encoder('d', 'doc_id', 't', 'b')},
        s AS (SELECT doc_id, slot, value FROM a UNION ALL SELECT doc_id, slot + 64, value FROM b)
        SELECT d.doc_id, g.slot, round(coalesce(value, 0)::FLOAT::DOUBLE, 6) AS value
        FROM d CROSS JOIN (SELECT unnest(range(128))::INT AS slot) g
        LEFT JOIN s ON s.doc_id = d.doc_id AND s.slot = g.slot""",
    "zero_shot": f"""WITH {lexicon('documents', 'doc_id', 'text', Q.LANGUAGE_LEXICON, 'best')}
        SELECT doc_id, label, round(score, 6) AS score FROM best""",
    "ingredient_flags": f"WITH {RAW}, {INGREDIENT_FLAGS} SELECT * FROM flags",
    "feature_build": f"WITH {BUILT} SELECT * FROM built",
    "feature_build_encoded": f"""WITH {BUILT} SELECT * REPLACE (
        {', '.join(code(c) for c in K.LABEL_COLUMNS)}) FROM built""",
    "search_e2e": f"""WITH {PAIRS}, {FACETS},
        limits AS (SELECT item_id AS query_id, label FROM vectors),
        ok AS (
          SELECT p.query_id, p.item_id, {DEMOTED} AS score FROM pairs p
          JOIN limits l ON l.query_id = p.query_id JOIN facets f ON f.item_id = p.item_id
          WHERE l.label <> 0 AND f.calories >= 1000 AND f.calories <= 100000.0 + l.label * 50000
            AND (l.label < 3 OR l.label >= 6 OR f.cooking_methods IN ('1-URGENT', '5-LOW'))
            AND (l.label <= 7 OR f.nuts = 0) AND (l.label <> 4 OR f.time_mins <= 150)
            AND f.protein BETWEEN 0 AND 40 AND f.fat BETWEEN 0 AND 50 AND f.carbs BETWEEN 0 AND 100),
        enough AS (SELECT query_id FROM ok GROUP BY query_id HAVING count(*) >= 40),
        {ranked('ok', 'score', 'top', 5, 'query_id IN (FROM enough)')}
        SELECT query_id, 'ok' AS status, rank, item_id, round(score, 6) AS score, 'order/' || item_id AS url FROM top
        UNION ALL SELECT query_id, CASE WHEN label = 0 THEN 'incomplete_query' ELSE 'too_few_candidates' END,
          NULL, NULL, NULL, NULL FROM limits WHERE query_id NOT IN (FROM enough)""",
    "search_shared_filter": f"""WITH {PAIRS}, {FACETS},
        {ranked('pairs', DEMOTED, 'top', 5, f'item_id IN (SELECT item_id FROM facets WHERE {OPEN_WHERE})')}
        SELECT query_id, 'ok' AS status, rank, item_id, round(score, 6) AS score, 'order/' || item_id AS url FROM top""",
    "hit_report": f"WITH {BOTH_METHODS} {report(['restricted', 'blended'])}",
    "eval_listing": f"""WITH {BOTH_METHODS}, rows AS (
          SELECT query_id, 'request' AS source, 0 AS rank, query_id AS item_id FROM (SELECT DISTINCT query_id FROM golden)
          UNION ALL SELECT DISTINCT query_id, 'golden', NULL, relevant_id FROM golden
          UNION ALL SELECT query_id, method, rank, item_id FROM found)
        SELECT query_id, source, rank, item_id, 'order/' || o_orderkey AS url FROM rows LEFT JOIN orders ON o_orderkey = item_id""",
    "method_report": f"""WITH {TURNS},
        {overlap_topk('turns', 'asked', [('directions', 'directions'), ('ingr', 'ingredients')], 10)},
        {tfidf_topk('turns', 'asked', "directions || ' ' || ingr", "directions || '. ' || ingredients", 10)},
        {TURN_VECTORS}, {ranked('turn_pairs', DEMOTED, 'embedding', 10)},
        {ranked('turn_pairs', '0.6::DOUBLE * sim + (1 - 0.6::DOUBLE) * matches', 'main', 10, 'sim >= 0.3::DOUBLE AND sim <= 0.95::DOUBLE')},
        {ranked('turn_pairs', 'sim', 'fb', 10)},
        full_band AS (SELECT query_id FROM main GROUP BY query_id HAVING count(*) = 10),
        found AS (SELECT 'words' AS method, query_id, item_id FROM overlap UNION ALL
                  SELECT 'tfidf', query_id, item_id FROM tfidf UNION ALL
                  SELECT 'embedding', query_id, item_id FROM embedding UNION ALL
                  SELECT 'blended', query_id, item_id FROM main WHERE query_id IN (FROM full_band) UNION ALL
                  SELECT 'blended', query_id, item_id FROM fb WHERE query_id NOT IN (FROM full_band))
        {report(METHODS)}""",
}

# The same answers by another way: several query blocks, an index with gaps, another store.
ORACLE |= {
    "word_overlap_blocks": ORACLE["word_overlap_topk"],
    "tfidf_blocks": ORACLE["tfidf_topk"],
    "vector_topk_blocks": ORACLE["vector_topk"],
    "vector_topk_some_facets": ORACLE["vector_topk"],
    "token_sets_parquet": ORACLE["token_store"],
    "search_unlinked": ORACLE["search_e2e"].replace(
        "'order/' || item_id AS url FROM top",
        "CASE WHEN o_orderstatus = 'F' THEN 'order/' || item_id END AS url FROM top LEFT JOIN orders ON o_orderkey = item_id",
    ),
    "facets_csv_roundtrip": f"WITH {FACETS} SELECT * FROM facets",
    "word_overlap_postings": ORACLE["word_overlap_topk"],
    "vector_topk_cells": ORACLE["vector_topk"],
    "tfidf_vocab_two_pass": ORACLE["tfidf_vocab"],
    "facet_filter_clustered": ORACLE["facet_filter"],
    "facet_filter_packed": ORACLE["facet_filter"],
    "facet_match_packed": ORACLE["facet_match"],
    "zero_shot_columns": ORACLE["zero_shot"],
    "encoded_csv_roundtrip": ORACLE["feature_build_encoded"],
    "golden_file": ORACLE["golden_explode"],
}

# A vocabulary as a table, in an order of its own.
VOCABULARY = """v AS (SELECT name, md5(name) AS pos FROM (
    SELECT p_brand AS name FROM part UNION SELECT p_name FROM part UNION SELECT unnest(string_split(p_name, ' ')) FROM part))"""

ORACLE |= {
    "first_category_table": f"""WITH {VOCABULARY} SELECT p_partkey, coalesce(min_by(name, pos), 'None') AS category
        FROM part LEFT JOIN v ON contains(p_name, name) GROUP BY p_partkey""",
    "vocab_split_table": f"""WITH {VOCABULARY},
        a AS (SELECT '\\b(?:' || string_agg(name, '|' ORDER BY pos) || ')\\b' AS pattern FROM v),
        s AS (SELECT p_partkey, unnest([{PART_CATEGORIES}, p_name]) AS cat FROM part),
        x AS (SELECT p_partkey, cat, pattern, regexp_extract_all(cat, pattern) AS found FROM s, a),
        y AS (SELECT DISTINCT p_partkey, unnest(CASE WHEN len(found) = 0 THEN [cat] ELSE list_concat(found, list_filter(
          list_transform(string_split_regex(cat, pattern), lambda p: trim(p)), lambda p: p <> '')) END) AS part FROM x)
        SELECT p_partkey, string_agg(part, ', ' ORDER BY part) AS parts FROM y GROUP BY p_partkey""",
    "request_guards": """SELECT o_orderkey, CASE WHEN o_custkey % 60 NOT BETWEEN 1 AND 50 THEN 'k_out_of_range'
        WHEN o_orderstatus = 'P' THEN 'no_filter_features' ELSE 'ok' END AS status FROM orders""",
    "csv_bad_cells": """SELECT 'calories' AS "column", count(*) FILTER (o_orderstatus = 'F') AS unreadable, count(*) AS n FROM orders
        UNION ALL SELECT 'time_mins', count(*), count(*) FROM orders UNION ALL SELECT 'fat', 0, count(*) FROM orders""",
    "positional_align": """SELECT row_number() OVER (ORDER BY doc_id) - 1 AS pos, doc_id, length(text)::INT AS n, lang,
        sha256(text) AS digest FROM documents""",
    "label_batches": f"""WITH {RAW},
        lines AS (SELECT item_id, fat, unnest(string_split(ingr, ',  ')) AS line FROM raw),
        line AS (SELECT line, bool_or(fat <= 10) AS early FROM lines GROUP BY line),
        {lexicon('line', 'line', 'line', K.INGREDIENT_LEXICON, 'grp')}
        SELECT item_id, line, CASE WHEN score > 0.6::DOUBLE THEN label END AS grp,
          CASE WHEN early THEN 'first' ELSE 'second' END AS batch FROM lines JOIN line USING (line) JOIN grp USING (line)""",
    "candidates_per_query": f"""WITH {VECTORS}, {FACETS} SELECT q.item_id AS query_id, i.item_id
        FROM vectors q CROSS JOIN vectors i JOIN facets f ON f.item_id = i.item_id
        WHERE f.calories >= 1000 AND f.calories <= 100000.0 + q.label * 50000
          AND (q.label < 3 OR q.label >= 6 OR f.cooking_methods IN ('1-URGENT', '5-LOW'))
          AND (q.label <= 7 OR f.nuts = 0) AND (q.label <> 4 OR f.time_mins <= 150)
          AND f.protein BETWEEN 0 AND 40 AND f.fat BETWEEN 0 AND 50 AND f.carbs BETWEEN 0 AND 100""",
}
