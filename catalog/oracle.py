"""DuckDB SQL for the registered queries, over the same Parquet tables.

Each query is a chain of the named views it needs and one final SELECT.
"""

from __future__ import annotations

from catalog import views as v
from marquee.functions import text as tx
from marquee.operators.entities import ALLOWED_LABELS
from marquee.operators.tokens import CORPUS_STOP_WORDS

SP = tx.SPACE_CLASS
RUN = tx.WORD_RUN


def quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def in_list(items) -> str:
    return "(" + ", ".join(quoted(i) for i in items) + ")"


def values(rows, names: str) -> str:
    shown = ", ".join("(" + ", ".join(quoted(x) if isinstance(x, str) else repr(x) for x in row) + ")" for row in rows)
    return f"SELECT * FROM (VALUES {shown}) AS t({names})"


MODELS = values([("logistic_regression",), ("linear_svm",), ("uniform_baseline",)], "model")

# --- views ------------------------------------------------------------------------

VIEWS: dict[str, str] = {}
ORDER: list[str] = []


def view(name: str, sql: str) -> None:
    VIEWS[name] = sql
    ORDER.append(name)


def query(select: str, *needs: str) -> str:
    """WITH the needed views, in the order they were defined."""
    wanted = set()

    def need(name: str) -> None:
        wanted.add(name)
        for other in ORDER:
            if other not in wanted and f" {other}_v" in VIEWS[name]:
                need(other)

    for name in needs:
        need(name)
    chain = ",\n".join(f"{n}_v AS ({VIEWS[n]})" for n in ORDER if n in wanted)
    return f"WITH {chain}\n{select}" if chain else select


view(
    "reviews",
    """
    SELECT 'tt' || p_partkey AS movie_id, p_name AS movie_title, 'rw' || doc_id AS review_id,
           'u' || o_custkey AS author,
           CAST(CAST(round(o_totalprice) AS BIGINT) % 10 + 1 AS DOUBLE) AS author_rating,
           CAST(CAST(floor(o_totalprice) AS BIGINT) % 97 AS INTEGER) AS upvotes,
           CAST(o_custkey % 23 AS INTEGER) AS downvotes,
           strftime(o_orderdate, '%Y-%m-%d') AS submission_date,
           split_part(text, chr(10), 1) AS summary, text AS content, doc_id
    FROM documents JOIN orders ON doc_id = o_orderkey JOIN part ON p_partkey = o_orderkey % 40
    """,
)
view(
    "raw",
    """
    SELECT movie_id, movie_title, review_id,
           CASE WHEN doc_id % 37 <> 0 THEN author END AS author,
           CASE WHEN doc_id % 41 = 0 THEN 7.5 WHEN doc_id % 17 <> 0 THEN author_rating END AS author_rating,
           CASE WHEN doc_id % 23 <> 0 THEN CAST(upvotes + copy_no AS INTEGER) END AS upvotes, downvotes,
           CASE WHEN doc_id % 29 <> 0 THEN submission_date END AS submission_date,
           CASE WHEN doc_id % 31 <> 0 THEN CASE WHEN copy_no = 1 THEN 'again' ELSE summary END END AS summary,
           CASE WHEN doc_id % 19 = 0 THEN chr(10) || '  ' || chr(13) ELSE content END AS content,
           doc_id, copy_no
    FROM (SELECT *, 0 AS copy_no FROM reviews_v UNION ALL SELECT *, 1 AS copy_no FROM reviews_v WHERE doc_id % 10 = 0)
    """,
)
view("movies", "SELECT 'tt' || p_partkey AS movie_id, p_name AS movie_title FROM part WHERE p_partkey < 40")
DOC = """
    SELECT coalesce(review_id, '') AS id, coalesce(movie_id, '') AS movie_id, coalesce(movie_title, '') AS movie_title,
           coalesce(author, '') AS author, coalesce(author_rating, 0.0) AS author_rating,
           coalesce(upvotes, 0) AS upvotes, coalesce(downvotes, 0) AS downvotes,
           coalesce(upvotes, 0) / CAST(coalesce(upvotes, 0) + coalesce(downvotes, 0) + 1 AS DOUBLE) AS helpfulness_score,
           CAST(submission_date AS TIMESTAMP) AS submission_date,
           coalesce(CAST(substr(submission_date, 1, 4) AS INTEGER), 0) AS year,
           coalesce(summary, '') AS summary, coalesce(content, '') AS content, '' AS sentiment
    FROM {source}
"""
view("docs", DOC.format(source=" reviews_v"))
view(
    "combined",
    "SELECT review_id, movie_id, movie_title, doc_id, coalesce(summary, '') || ' ' || coalesce(content, '') AS text FROM reviews_v",
)
view(
    "mentions",
    """
    SELECT r.review_id, r.movie_title,
           r.content || '. I saw ' || CASE r.doc_id % 3 WHEN 0 THEN r.movie_title WHEN 1 THEN o.movie_title
             ELSE r.movie_title || ' and ' || o.movie_title END || '. The end.' AS text
    FROM reviews_v r JOIN movies_v o ON o.movie_id = 'tt' || ((r.doc_id + 1) % 40)
    """,
)
view(
    "keys",
    f"""
    SELECT DISTINCT regexp_replace(lower(movie_title), '[^a-z0-9{SP}]', '', 'g') AS key, movie_title AS title
    FROM movies_v UNION SELECT alias, movie_title FROM ({values(v.ALIASES, "alias, movie_title")})
    """,
)
view(
    "truth",
    "SELECT 'rw' || doc_id AS review_id, doc_id, quality AS polarity, toxic FROM labels",
)
view(
    "entities",
    r"""
    SELECT review_id, pos, CASE pos % 3 WHEN 0 THEN 'PERSON' WHEN 1 THEN 'ORG' ELSE 'GPE' END AS label,
           CASE WHEN pos % 5 = 0 THEN word || ' Jr' ELSE word END AS value
    FROM (SELECT review_id, unnest(w) AS word, unnest(range(len(w))) AS pos
          FROM (SELECT 'rw' || doc_id AS review_id, regexp_extract_all(text, '\p{L}{7,}') AS w FROM documents))
    """,
)
view(
    "entity_text",
    f"""
    SELECT review_id, string_agg('ENTLBL_' || label || ' ENTTXT_' || token, ' ' ORDER BY pos) AS ner_text
    FROM (SELECT review_id, label, replace(lower(trim(value)), ' ', '_') AS token, min(pos) AS pos
          FROM entities_v WHERE label IN {in_list(ALLOWED_LABELS)} GROUP BY ALL)
    GROUP BY review_id
    """,
)
view(
    "annotated",
    """
    SELECT r.review_id, r.movie_id, r.summary, r.content,
           CASE WHEN toxic = 1 THEN 'NEUTRAL' ELSE 'SUBJECTIVE' END AS subjective_label_a,
           CASE WHEN toxic = 1 THEN 'NEUTRAL' WHEN polarity = 1 THEN 'POSITIVE' ELSE 'NEGATIVE' END AS polarity_label_a,
           'SUBJECTIVE' AS subjective_label_b,
           CASE WHEN t.doc_id % 17 = 0 THEN NULL
                WHEN (polarity = 1) <> (t.doc_id % 11 = 0) THEN 'POSITIVE' ELSE 'NEGATIVE' END AS polarity_label_b,
           CASE WHEN t.doc_id % 19 = 0 THEN 'NEUTRAL' ELSE 'SUBJECTIVE' END AS subjective_label_c,
           CASE WHEN t.doc_id % 19 = 0 OR t.doc_id % 13 = 0 THEN 'NEUTRAL'
                WHEN polarity = 1 THEN 'POSITIVE' ELSE 'NEGATIVE' END AS polarity_label_c
    FROM truth_v t JOIN reviews_v r USING (review_id)
    """,
)
view(
    "predictions",
    " UNION ALL ".join(
        f"SELECT review_id, polarity, '{s}' AS text_source, '{m}' AS model, "
        f"CASE WHEN doc_id % {n} = 0 THEN 1 - polarity ELSE polarity END AS predicted FROM truth_v"
        for s, m, n in v.WRONG
    ),
)
view(
    "per_label",
    """
    SELECT text_source, model, label,
           CASE WHEN pred = 0 THEN 0.0 ELSE hit / pred END AS precision,
           CASE WHEN truth = 0 THEN 0.0 ELSE hit / truth END AS recall,
           CASE WHEN truth + pred = 0 THEN 0.0 ELSE 2 * hit / (truth + pred) END AS f1_score,
           truth AS support, hit
    FROM (SELECT text_source, model, label,
                 CAST(count(*) FILTER (polarity = label) AS DOUBLE) AS truth,
                 CAST(count(*) FILTER (predicted = label) AS DOUBLE) AS pred,
                 CAST(count(*) FILTER (polarity = label AND predicted = label) AS DOUBLE) AS hit
          FROM predictions_v, (VALUES (0), (1)) AS l(label) GROUP BY ALL)
    """,
)
view(
    "report",
    """
    SELECT text_source, model, CASE label WHEN 1 THEN 'POSITIVE' ELSE 'NEGATIVE' END AS label,
           precision, recall, f1_score, support FROM per_label_v
    UNION ALL
    SELECT text_source, model, 'accuracy', a, a, a, a
    FROM (SELECT text_source, model, sum(hit) / sum(support) AS a FROM per_label_v GROUP BY ALL)
    UNION ALL
    SELECT text_source, model, 'macro avg', avg(precision), avg(recall), avg(f1_score), sum(support)
    FROM per_label_v GROUP BY ALL
    UNION ALL
    SELECT text_source, model, 'weighted avg', sum(precision * support) / sum(support),
           sum(recall * support) / sum(support), sum(f1_score * support) / sum(support), sum(support)
    FROM per_label_v GROUP BY ALL
    """,
)
view(
    "summary",
    """
    SELECT text_source, model, max(f1_score) FILTER (label = 'accuracy') AS accuracy,
           max(f1_score) FILTER (label = 'macro avg') AS macro_f1,
           max(f1_score) FILTER (label = 'weighted avg') AS weighted_f1
    FROM report_v GROUP BY ALL
    """,
)
view(
    "best",
    """
    SELECT * FROM summary_v
    QUALIFY row_number() OVER (PARTITION BY text_source ORDER BY weighted_f1 DESC, accuracy DESC, model) = 1
    """,
)


# --- text -------------------------------------------------------------------------


def basic_clean(text: str) -> str:
    sql = f"regexp_replace(lower({text}), '{tx.URL}', '', 'g')"
    for old, new in [*tx.mangled_forms(), *tx.wide_folds()]:
        sql = f"replace({sql}, {quoted(old)}, {quoted(new)})"
    source, target = tx.letter_folds()
    return f"regexp_replace(translate({sql}, {quoted(source)}, {quoted(target)}), '{tx.BRACKETS}', ' ', 'g')"


def words(text: str) -> str:
    return f"regexp_extract_all({text}, '{RUN}')"


def swap(tokens: str, mapping: dict[str, str]) -> str:
    cases = " ".join(f"WHEN {quoted(k)} THEN {quoted(x)}" for k, x in mapping.items())
    return f"list_transform({tokens}, lambda t: CASE t {cases} ELSE t END)"


def slang(text: str) -> str:
    return f"array_to_string({swap(words(text), dict(v.GENERAL_SLANG) | dict(v.DOMAIN_SLANG))}, ' ')"


def deep_clean(text: str) -> str:
    return f"regexp_replace({text}, '[^a-zA-Z0-9{SP}]', '', 'g')"


def lemma_stop(text: str) -> str:
    lemmas = {w: x.lower() for w, x in v.LEMMAS}
    swapped = f"list_transform({swap(words(text), lemmas)}, lambda t: lower(t))"
    unwanted = in_list(dict.fromkeys([*v.STOP_WORDS, *CORPUS_STOP_WORDS]))
    kept = rf"list_filter({swapped}, lambda t: regexp_matches(t, '[\p{{L}}\p{{N}}]') AND t NOT IN {unwanted})"
    return f"array_to_string({kept}, ' ')"


def plain_letters(text: str) -> str:
    return f"regexp_replace(lower({text}), '[^a-z0-9{SP}]', '', 'g')"


view("slanged", f"SELECT review_id, {slang('text')} AS text FROM (SELECT review_id, {basic_clean('text')} AS text FROM combined_v)")
view("processed", f"SELECT review_id, {lemma_stop('text')} AS processed_text FROM (SELECT review_id, {deep_clean('text')} AS text FROM slanged_v)")
view(
    "sentences",
    rf"""
    SELECT review_id, movie_title, unnest(s) AS sentence, unnest(range(len(s))) AS pos
    FROM (SELECT review_id, movie_title,
                 string_split(regexp_replace(text, '([.!?])[{SP}]+', '\1' || chr(1), 'g'), chr(1)) AS s FROM mentions_v)
    """,
)
view(
    "kept",
    f"""
    SELECT review_id, coalesce(string_agg(sentence, ' ' ORDER BY pos) FILTER (keep), '') AS text
    FROM (SELECT s.review_id, s.pos, s.sentence,
                 count(k.key) = 0 OR bool_or({plain_letters('k.title')} = {plain_letters('s.movie_title')}) AS keep
          FROM sentences_v s LEFT JOIN keys_v k ON contains({plain_letters('s.sentence')}, k.key)
          GROUP BY ALL)
    GROUP BY review_id
    """,
)

# --- search -----------------------------------------------------------------------

TOKEN = r"[\p{L}\p{N}]+"
COLUMN = {"summary": "summary", "content": "content", "movie_title_t": "movie_title"}
view(
    "tokens",
    " UNION ALL ".join(
        f"SELECT id, '{f}' AS field, regexp_extract_all(lower({c}), '{TOKEN}') AS t FROM docs_v"
        for f, c in COLUMN.items()
    ),
)
view(
    "field_stats",
    "SELECT field, count(*) AS n, sum(len(t)) / CAST(count(*) AS DOUBLE) AS mean FROM tokens_v WHERE len(t) > 0 GROUP BY field",
)
view(
    "places",
    "SELECT id, field, len(t) AS field_len, unnest(t) AS term, unnest(range(len(t))) AS pos FROM tokens_v",
)
view(
    "postings",
    """
    SELECT field, term, id, count(*) AS tf, string_agg(CAST(pos AS VARCHAR), ' ' ORDER BY pos) AS positions, field_len
    FROM places_v GROUP BY field, term, id, field_len
    """,
)


def bm25(idf: str, tf: str) -> str:
    return f"({idf}) * {tf} / ({tf} + 1.2 * (0.25 + 0.75 * field_len / mean))"


IDF = "ln(1 + (n - df + 0.5) / (df + 0.5))"


def term_scores(terms: list[str], fields=("content",)) -> str:
    """(id, score) over single terms."""
    return f"""
    SELECT id, sum({bm25(IDF, 'tf')}) AS score
    FROM (SELECT *, count(*) OVER (PARTITION BY field, term) AS df
          FROM (SELECT field, term, id, field_len, CAST(count(*) AS DOUBLE) AS tf FROM places_v
                WHERE term IN {in_list(terms)} AND field IN {in_list(fields)} GROUP BY ALL))
    JOIN field_stats_v USING (field) GROUP BY id
    """


def pair_scores(first: str, second: str) -> str:
    """(id, score) over a phrase of two words in `content`."""
    return f"""
    SELECT id, {bm25('(SELECT sum(' + IDF + ') FROM dfs)', 'tf')} AS score
    FROM (SELECT a.id, 'content' AS field, a.field_len, CAST(count(*) AS DOUBLE) AS tf
          FROM places_v a JOIN places_v b ON a.id = b.id AND a.field = b.field AND b.pos = a.pos + 1
          WHERE a.field = 'content' AND a.term = {quoted(first)} AND b.term = {quoted(second)} GROUP BY ALL)
    JOIN field_stats_v USING (field)
    """


def pair_query(select: str, first: str, second: str) -> str:
    dfs = f"""dfs AS (SELECT term, count(DISTINCT id) AS df, any_value(n) AS n FROM places_v JOIN field_stats_v USING (field)
              WHERE field = 'content' AND term IN {in_list([first, second])} GROUP BY term),
              scores AS ({pair_scores(first, second)})"""
    return _with_more(select, dfs)


def _with_more(select: str, more: str) -> str:
    base = query("", "docs", "places", "field_stats").rstrip()
    return f"{base},\n{more}\n{select}"


HIT = "id, movie_title, round(helpfulness_score, 6) AS helpfulness_score"


def top(scores: str, where: str = "true", by: str = "score", k: int = 10, columns: str = HIT, score: str = "score") -> str:
    select = f"""
    SELECT {columns}, round({score}, 6) AS score FROM scores JOIN docs_v USING (id)
    WHERE {where} ORDER BY {by} DESC, id LIMIT {k}"""
    return _with_more(select, f"scores AS ({scores})")


ONE = term_scores(["worthless"])
HITS = "SELECT d.* FROM docs_v d JOIN scores USING (id)"


def over_hits(select: str) -> str:
    return _with_more(select, f"scores AS ({ONE}), hits AS ({HITS})")


REVIEW_SQL = top(
    term_scores(["plate", "of", "pathetic"], COLUMN),
    """author_rating >= 3 AND submission_date >= TIMESTAMP '1996-01-01 00:00:00'
       AND submission_date <= TIMESTAMP '2000-12-31 23:59:59'
       AND list_contains(regexp_extract_all(lower(movie_title), '[\\p{L}\\p{N}]+'), 'plate')
       AND list_contains(regexp_extract_all(lower(movie_title), '[\\p{L}\\p{N}]+'), 'red')""",
    columns="""id, movie_title, summary, substr(content, 1, 320) AS snippet, author, author_rating, upvotes, downvotes,
       round(helpfulness_score, 6) AS helpfulness_score, strftime(submission_date, '%Y-%m-%d') AS date""",
)
PHRASE_SQL = pair_query(
    f"SELECT {HIT}, round(score, 6) AS score FROM scores JOIN docs_v USING (id) ORDER BY scores.score DESC, id LIMIT 10",
    "of",
    "the",
)

DOC_ROW = """id, movie_id, movie_title, author, author_rating, upvotes, downvotes,
    round({h}, 6) AS helpfulness_score, strftime(submission_date, '%Y-%m-%d %H:%M:%S') AS submission_date,
    year, summary, content, sentiment"""

ONE_LINE = "trim(translate(coalesce({c}, ''), chr(10) || chr(13), '  '))"

# --- features ---------------------------------------------------------------------

view(
    "grams",
    r"""
    SELECT review_id, unnest(list_concat(w, list_transform(range(1, greatest(len(w), 1)), lambda i: w[i] || ' ' || w[i + 1]))) AS term
    FROM (SELECT review_id, regexp_extract_all(lower(content), '[\p{L}\p{N}_]{2,}') AS w FROM reviews_v)
    """,
)
view("gram_tf", "SELECT review_id, term, count(*) AS tf FROM grams_v GROUP BY ALL")
view(
    "vocabulary",
    """
    SELECT term, ln((1 + (SELECT count(*) FROM reviews_v)) / CAST(1 + count(*) AS DOUBLE)) + 1 AS idf
    FROM gram_tf_v GROUP BY term HAVING count(*) >= 2 ORDER BY sum(tf) DESC, term LIMIT 5000
    """,
)
view(
    "tfidf",
    """
    SELECT review_id, term, w / sqrt(sum(w * w) OVER (PARTITION BY review_id)) AS weight
    FROM (SELECT review_id, term, tf * idf AS w FROM gram_tf_v JOIN vocabulary_v USING (term))
    """,
)


def _kappa(kind: str, columns: list[str], categories: list[str]) -> str:
    usable = " AND ".join(f"coalesce({c} IN {in_list(categories)}, false)" for c in columns)
    votes = [" + ".join(f"CAST({c} = {quoted(x)} AS INTEGER)" for c in columns) for x in categories]
    return f"""
    SELECT '{kind}' AS kind, rows_used, 3 AS annotators, round(p0, 6) AS share_0, round(p1, 6) AS share_1,
           round(po, 6) AS observed_agreement, round(pe, 6) AS expected_agreement,
           round(CASE WHEN abs(1 - pe) > 1e-8 THEN (po - pe) / (1 - pe) END, 6) AS fleiss_kappa,
           CASE WHEN abs(1 - pe) <= 1e-8 THEN 'UNDEFINED' WHEN (po - pe) / (1 - pe) >= 0.8 THEN 'PASS' ELSE 'BELOW 0.80' END AS status
    FROM (SELECT *, p0 * p0 + p1 * p1 AS pe FROM (
      SELECT count(*) AS rows_used, sum(a) / (count(*) * 3.0) AS p0, sum(b) / (count(*) * 3.0) AS p1,
             avg((a * a + b * b - 3) / 6.0) AS po
      FROM (SELECT {votes[0]} AS a, {votes[1]} AS b FROM annotated_v WHERE {usable})))
    """


POLARITY = [f"polarity_label_{w}" for w in "abc"]
SUBJECTIVE = [f"subjective_label_{w}" for w in "abc"]


def _vote(columns: list[str]) -> str:
    a, b, c = columns
    # Three votes: two equal ones win, otherwise the first one given.
    return f"CASE WHEN {a} = {b} OR {a} = {c} THEN {a} WHEN {b} = {c} THEN {b} ELSE coalesce({a}, {b}, {c}) END"


def _distribution(kind: str, columns: list[str]) -> str:
    counts = ", ".join(f"count(*) FILTER (who = '{c}') AS {c[-1]}" for c in columns)
    rows = " UNION ALL ".join(f"SELECT '{c}' AS who, {c} AS label FROM annotated_v" for c in columns)
    return f"SELECT '{kind}' AS kind, label, {counts} FROM ({rows}) GROUP BY label"


DRAW = "md5('{seed}:' || review_id)"

LABEL_SAMPLE = f"""
, base AS (SELECT *, {DRAW.format(seed=42)} AS draw FROM reviews_v),
cells AS (SELECT author_rating, movie_title, count(*) AS n FROM base GROUP BY ALL),
goals AS (SELECT author_rating, least(40, sum(n)) AS goal, count(*) AS movies FROM cells GROUP BY ALL),
quotas AS (SELECT author_rating, movie_title, n, goal, goal // movies
             + CASE WHEN row_number() OVER (PARTITION BY author_rating ORDER BY movie_title) <= goal % movies THEN 1 ELSE 0 END AS quota
           FROM cells JOIN goals USING (author_rating)),
placed AS (SELECT b.*, q.quota, row_number() OVER (PARTITION BY author_rating, movie_title ORDER BY draw, review_id) <= q.quota AS first
           FROM base b JOIN quotas q USING (author_rating, movie_title)),
gaps AS (SELECT author_rating, any_value(goal) - sum(least(n, quota)) AS gap FROM quotas GROUP BY ALL),
second AS (SELECT review_id FROM (
    SELECT review_id, author_rating, row_number() OVER (PARTITION BY author_rating ORDER BY draw, review_id) AS rn
    FROM placed WHERE NOT first) JOIN gaps USING (author_rating) WHERE rn <= gap),
inside AS (SELECT review_id FROM placed WHERE first UNION ALL SELECT review_id FROM second),
others AS (SELECT review_id FROM (
    SELECT review_id, row_number() OVER (ORDER BY draw, review_id) AS rn FROM base
    WHERE review_id NOT IN (SELECT review_id FROM inside)) WHERE rn <= 400 - (SELECT count(*) FROM inside))
SELECT review_id, movie_id, movie_title, CAST(author_rating AS INTEGER) AS author_rating, submission_date, summary, content,
       '' AS subjective_label, '' AS polarity_label, '' AS notes
FROM reviews_v WHERE review_id IN (SELECT review_id FROM inside UNION ALL SELECT review_id FROM others)
"""

R = "movie_id, movie_title, review_id, author, author_rating, upvotes, downvotes, submission_date, summary, content"
PAGE = "FROM reviews_v WHERE NOT (movie_id = 'tt3' AND doc_id // 250 = 0)"
COMPARE = """
SELECT text_source, model, round(accuracy, 3) AS accuracy, round(p, 3) AS macro_precision, round(r, 3) AS macro_recall,
       round(f, 3) AS macro_f1_score, round(weighted_f1, 3) AS weighted_f1,
       CASE WHEN seconds > 0 THEN round((SELECT count(*) FROM labels) / seconds, 2) ELSE CAST('inf' AS DOUBLE) END AS throughput,
       CAST(row_number() OVER (PARTITION BY text_source ORDER BY weighted_f1 DESC, model) AS INTEGER) AS rank,
       row_number() OVER (ORDER BY weighted_f1 DESC, text_source DESC, model DESC) = 1 AS overall_best
FROM summary_v JOIN times USING (text_source, model)
JOIN (SELECT text_source, model, precision AS p, recall AS r, f1_score AS f FROM report_v WHERE label = 'macro avg') USING (text_source, model)
"""


def _windows() -> str:
    from catalog.queries import WINDOWS

    parts = []
    for label, window in WINDOWS.items():
        where = "true" if window is None else f"submission_date BETWEEN TIMESTAMP '{window[0]}' AND TIMESTAMP '{window[1]}'"
        parts.append(f"SELECT '{label}' AS label, count(*) AS num_found FROM hits WHERE {where}")
    return " UNION ALL ".join(parts)


def _rankings() -> str:
    keys = {"bm25": "score", "by_helpfulness": "helpfulness_score", "boosted": "score + helpfulness_score"}
    return " UNION ALL ".join(
        f"""SELECT '{name}' AS variant, round(avg(helpfulness_score), 6) AS avg_helpfulness_top_n,
            (SELECT count(*) FROM scores) AS num_found
            FROM (SELECT helpfulness_score FROM hits JOIN scores USING (id) ORDER BY {by} DESC, id LIMIT 5)"""
        for name, by in keys.items()
    )


def oracle() -> dict[str, str]:
    nonblank = "length(trim(regexp_replace(content, '[" + SP + "]+', ' ', 'g'))) > 0"
    first_copy = "row_number() OVER (PARTITION BY review_id ORDER BY copy_no) = 1"
    complete = " AND ".join(f"{c.strip()} IS NOT NULL" for c in R.split(","))
    coin = f"CASE WHEN substr({DRAW.format(seed=99)}, 1, 1) < '8' THEN 0 ELSE 1 END"
    facet = "SELECT {c} AS value, count(*) AS count FROM hits WHERE {c} IS NOT NULL AND {c} <> '' GROUP BY ALL ORDER BY count DESC, value LIMIT {k}"
    made = {
        "flatten_pages": query(
            f"""SELECT movie_id, movie_title, review_id, CASE WHEN downvotes <> 5 THEN author END AS author, author_rating,
                CASE WHEN downvotes <> 6 THEN upvotes END AS upvotes, CASE WHEN downvotes <> 6 THEN downvotes END AS downvotes,
                submission_date, summary, CASE WHEN downvotes <> 7 THEN content END AS content {PAGE}""",
            "reviews",
        ),
        "page_status": query(
            f"""SELECT movie_id, page_no, n_reviews, has_next_page, CASE WHEN has_next_page THEN movie_id || '-' || page_no END AS end_cursor,
                NOT has_next_page AS is_last
                FROM (SELECT movie_id, doc_id // 250 AS page_no, CAST(count(*) AS INTEGER) AS n_reviews,
                      doc_id // 250 < (SELECT max(doc_id // 250) FROM reviews_v) AS has_next_page {PAGE} GROUP BY movie_id, doc_id // 250)""",
            "reviews",
        ),
        "upsert_reviews": query(
            f"""SELECT {DOC_ROW.format(h='helpfulness_score')} FROM (
                SELECT * REPLACE (CASE WHEN id LIKE '%00' THEN upvotes + 200 WHEN id LIKE '%0' THEN upvotes + 100 ELSE upvotes END AS upvotes,
                                  CASE WHEN id LIKE '%00' THEN 'third' WHEN id LIKE '%0' THEN 'second' ELSE summary END AS summary)
                FROM docs_v UNION ALL SELECT * REPLACE (id || 'n' AS id) FROM docs_v WHERE id LIKE '%7')""",
            "docs",
        ),
        "clean_reviews": query(
            f"""SELECT * FROM (SELECT movie_id, movie_title, review_id, author, author_rating, upvotes, downvotes, submission_date,
                {ONE_LINE.format(c='summary')} AS summary, {ONE_LINE.format(c='content')} AS content FROM raw_v QUALIFY {first_copy})
                WHERE length(content) > 0""",
            "raw",
        ),
        "valid_ratings": query(
            f"""SELECT * REPLACE (CAST(author_rating AS INTEGER) AS author_rating) FROM (
                SELECT {R} FROM raw_v WHERE {complete} QUALIFY {first_copy})
                WHERE {nonblank} AND author_rating IN (1, 2, 3, 4, 5, 6, 7, 8, 9, 10)""",
            "raw",
        ),
        "index_docs": query(f"SELECT {DOC_ROW.format(h='helpfulness_score')} FROM ({DOC.format(source='raw_v')})", "raw"),
        "combine_text": query(
            "SELECT review_id, copy_no, coalesce(summary, '') || ' ' || coalesce(content, '') AS text FROM raw_v", "raw"
        ),
        "basic_clean": query(f"SELECT review_id, {basic_clean('text')} AS text FROM combined_v", "combined"),
        "expand_slang": query(f"SELECT review_id, {slang('lower(text)')} AS text FROM combined_v", "combined"),
        "deep_clean": query(f"SELECT review_id, {deep_clean('text')} AS text FROM combined_v", "combined"),
        "lemma_stop": query(f"SELECT review_id, {lemma_stop('lower(text)')} AS tokens FROM combined_v", "combined"),
        "preprocess": query("SELECT * FROM processed_v", "processed"),
        "find_titles": query(
            f"""SELECT review_id, coalesce(string_agg(DISTINCT k.title, '|' ORDER BY k.title), '') AS titles
                FROM mentions_v m LEFT JOIN keys_v k ON contains({plain_letters('m.text')}, k.key) GROUP BY review_id""",
            "mentions",
            "keys",
        ),
        "filter_sentences": query("SELECT * FROM kept_v", "kept"),
        "preprocess_for_title": query(
            f"""SELECT review_id, {lemma_stop(deep_clean('text'))} AS processed_text
                FROM (SELECT review_id, {slang(basic_clean('text'))} AS text FROM kept_v)""",
            "kept",
        ),
        "entity_features": query("SELECT * FROM entity_text_v", "entity_text"),
        "augment_text": query(
            """SELECT review_id, trim(coalesce(content, '') || ' [SEP] ' || coalesce(ner_text, '')) AS augmented_text
               FROM reviews_v LEFT JOIN entity_text_v USING (review_id)""",
            "reviews",
            "entity_text",
        ),
        "merge_annotators": query(
            """SELECT review_id, movie_id, summary, content,
                 CASE WHEN toxic = 1 THEN 'objective' ELSE 'subjective' END AS subjective_label_a,
                 CASE WHEN toxic = 1 THEN 'neutral' WHEN polarity = 1 THEN 'Positive' ELSE ' NEGATIVE ' END AS polarity_label_a,
                 'Subjective' AS subjective_label_b,
                 CASE WHEN t.doc_id % 17 = 0 THEN 'nan' WHEN (polarity = 1) <> (t.doc_id % 11 = 0) THEN 'Positive' ELSE ' NEGATIVE ' END AS polarity_label_b,
                 CASE WHEN t.doc_id % 19 = 0 THEN 'Objective ' ELSE 'subjective' END AS subjective_label_c,
                 CASE WHEN t.doc_id % 19 = 0 OR t.doc_id % 13 = 0 THEN 'neutral' WHEN polarity = 1 THEN 'Positive' ELSE ' NEGATIVE ' END AS polarity_label_c
               FROM truth_v t JOIN reviews_v r USING (review_id)""",
            "truth",
            "reviews",
        ),
        "normalize_labels": query("SELECT * EXCLUDE (summary, content) FROM annotated_v", "annotated"),
        "label_distribution": query(
            f"{_distribution('polarity', POLARITY)} UNION ALL {_distribution('subjective', SUBJECTIVE)}", "annotated"
        ),
        "fleiss_kappa": query(
            f"{_kappa('polarity', POLARITY, ['POSITIVE', 'NEGATIVE'])} UNION ALL {_kappa('subjective', SUBJECTIVE, ['SUBJECTIVE', 'NEUTRAL'])}",
            "annotated",
        ),
        "majority_vote": query(
            f"""SELECT review_id, movie_id, summary, content, {_vote(SUBJECTIVE)} AS ground_truth_subjectivity,
                {_vote(POLARITY)} AS ground_truth_polarity FROM annotated_v""",
            "annotated",
        ),
        "attach_text": query(
            "SELECT review_id, polarity, content FROM truth_v JOIN reviews_v USING (review_id)", "truth", "reviews"
        ),
        "unlabeled": query(
            "SELECT review_id, movie_id, author_rating FROM reviews_v WHERE doc_id NOT IN (SELECT doc_id FROM labels)", "reviews"
        ),
        "overlap_count": query(
            "SELECT count(*) AS n_common FROM reviews_v WHERE doc_id IN (SELECT doc_id FROM labels)", "reviews"
        ),
        "attach_sentiment": query(
            """SELECT id, movie_id, coalesce(CASE predicted WHEN 1 THEN 'POSITIVE' WHEN 0 THEN 'NEGATIVE' END, '') AS sentiment
               FROM docs_v LEFT JOIN (SELECT review_id AS id, predicted FROM predictions_v
               WHERE model = 'model_a' AND text_source = 'preprocessed_text') USING (id)""",
            "docs",
            "predictions",
        ),
        "movie_counts": query(
            """SELECT movie_id, movie_title, coalesce(n, 0) AS n_reviews
               FROM (SELECT 'tt' || p_partkey AS movie_id, p_name AS movie_title FROM part)
               LEFT JOIN (SELECT movie_id, count(*) AS n FROM raw_v GROUP BY ALL) USING (movie_id)""",
            "raw",
        ),
        "value_counts": query(
            """SELECT author_rating AS value, count(*) AS count, round(count(*) / CAST(sum(count(*)) OVER () AS DOUBLE), 6) AS share
               FROM raw_v WHERE author_rating IS NOT NULL GROUP BY ALL""",
            "raw",
        ),
        "corpus_stats": query(
            f"""SELECT (SELECT count(*) FROM raw_v) AS num_records, count(*) AS num_words, count(DISTINCT w) AS num_types
                FROM (SELECT unnest(string_split({plain_letters('content')}, ' ')) AS w FROM raw_v) WHERE w <> ''""",
            "raw",
        ),
        "top_words": query(
            f"""SELECT word, count(*) AS count FROM (SELECT unnest({words('processed_text')}) AS word FROM processed_v)
                GROUP BY ALL ORDER BY count DESC, word LIMIT 20""",
            "processed",
        ),
        "label_sample": query("", "reviews").rstrip() + LABEL_SAMPLE,
        "equal_rating_sample": query(
            f"""SELECT review_id, movie_id, movie_title, author_rating, summary, content, '' AS ground_truth FROM reviews_v
                WHERE doc_id NOT IN (SELECT doc_id FROM labels)
                QUALIFY row_number() OVER (PARTITION BY round_even(author_rating, 0) ORDER BY {DRAW.format(seed=99)}, review_id) <= 5""",
            "reviews",
        ),
        "stratified_split": query(
            f"""SELECT review_id, movie_title, author_rating,
                CASE WHEN count(*) OVER s > 1 AND row_number() OVER (s ORDER BY {DRAW.format(seed=42)}, review_id)
                          <= floor(count(*) OVER s * 0.2 + 0.5) THEN 'test' ELSE 'train' END AS split
                FROM reviews_v WINDOW s AS (PARTITION BY movie_title, author_rating)""",
            "reviews",
        ),
        "class_report": query(
            """SELECT text_source, model, label, round(precision, 6) AS precision, round(recall, 6) AS recall,
               round(f1_score, 6) AS f1_score, round(support, 6) AS support FROM report_v""",
            "report",
        ),
        "model_summary": query(
            """SELECT text_source, model, round(accuracy, 6) AS accuracy, round(macro_f1, 6) AS macro_f1,
               round(weighted_f1, 6) AS weighted_f1 FROM summary_v""",
            "summary",
        ),
        "best_model": query(
            """SELECT text_source, model, round(accuracy, 6) AS accuracy, round(macro_f1, 6) AS macro_f1,
               round(weighted_f1, 6) AS weighted_f1 FROM best_v""",
            "best",
        ),
        "best_predictions": query(
            "SELECT review_id, polarity, "
            + ", ".join(
                f"max(CASE WHEN p.text_source = '{s}' THEN p.model END) AS {s}_prediction_model, "
                f"max(CASE WHEN p.text_source = '{s}' THEN CASE p.predicted WHEN 1 THEN 'POSITIVE' ELSE 'NEGATIVE' END END) AS {s}_prediction_result"
                for s in ("preprocessed_text", "augmented_text")
            )
            + " FROM predictions_v p JOIN best_v b ON p.text_source = b.text_source AND p.model = b.model GROUP BY review_id, polarity",
            "predictions",
            "best",
        ),
        "labeled_report": query(
            f"""SELECT 'preprocessed_text' AS text_source, 'uniform_baseline' AS model, (SELECT count(*) FROM reviews_v) AS rows_scored,
                round(sum(hit) / sum(truth), 6) AS accuracy, round(avg(f1), 6) AS macro_f1, round(sum(f1 * truth) / sum(truth), 6) AS weighted_f1
                FROM (SELECT truth, hit, CASE WHEN truth + pred = 0 THEN 0.0 ELSE 2 * hit / (truth + pred) END AS f1
                  FROM (SELECT label, CAST(count(*) FILTER (polarity = label) AS DOUBLE) AS truth,
                        CAST(count(*) FILTER (p = label) AS DOUBLE) AS pred, CAST(count(*) FILTER (polarity = label AND p = label) AS DOUBLE) AS hit
                        FROM (SELECT polarity, {coin} AS p FROM truth_v), (VALUES (0), (1)) AS l(label) GROUP BY label))""",
            "reviews",
            "truth",
        ),
        "prediction_balance": query(
            """SELECT model, text_source, count(*) AS rows_scored, count(*) FILTER (predicted = 0) AS predicted_negative,
               count(*) FILTER (predicted = 1) AS predicted_positive, round(avg(predicted), 6) AS predicted_positive_share
               FROM predictions_v GROUP BY ALL""",
            "predictions",
        ),
        "compare_models": query("", "summary", "report").rstrip()
        + f", times AS ({values(v.TIMES, 'text_source, model, seconds')})"
        + COMPARE,
        "search_bm25": top(ONE),
        "search_terms_or": top(term_scores(["pathetic", "worthless", "thing"]), k=20),
        "search_phrase": PHRASE_SQL,
        "search_filtered": top(
            term_scores(["thing", "of"]),
            """movie_title = 'red plate' AND author_rating BETWEEN 1 AND 4
               AND submission_date BETWEEN TIMESTAMP '1995-01-01' AND TIMESTAMP '2000-12-31'""",
        ),
        "search_reviews": REVIEW_SQL,
        "search_by_helpfulness": top(ONE, by="docs_v.helpfulness_score"),
        "search_by_rating": top(ONE, by="author_rating"),
        "search_by_date": top(ONE, by="submission_date"),
        "search_boosted": top(ONE, by="scores.score + docs_v.helpfulness_score", score="scores.score + docs_v.helpfulness_score"),
        "search_postings": REVIEW_SQL,
        "index_bm25": top(ONE),
        "index_phrase": PHRASE_SQL,
        "index_filtered": top(
            term_scores(["thing", "of"]),
            """movie_title = 'red plate' AND author_rating BETWEEN 1 AND 4
               AND submission_date BETWEEN TIMESTAMP '1995-01-01' AND TIMESTAMP '2000-12-31 23:59:59'""",
        ),
        "index_windows": over_hits(_windows()),
        "search_postings_phrase": PHRASE_SQL,
        "postings": query("SELECT field, term, id, CAST(tf AS INTEGER) AS tf, positions, CAST(field_len AS INTEGER) AS field_len FROM postings_v", "postings"),
        "term_stats": query("SELECT field, term, count(DISTINCT id) AS df, count(*) AS total FROM places_v GROUP BY ALL", "places"),
        "title_exact_vs_terms": query(
            """SELECT 'exact_title' AS label, count(*) FILTER (movie_title = 'red plate') AS num_found FROM docs_v UNION ALL
               SELECT 'analysed_title', count(*) FROM docs_v WHERE regexp_matches(lower(movie_title), '\\b(red|plate)\\b')""",
            "docs",
        ),
        "helpfulness_compare": over_hits(_rankings()),
        "date_windows": over_hits(_windows()),
        "facet_movie": over_hits(facet.format(c="movie_title", k=20)),
        "facet_movie_all": over_hits(
            """SELECT movie_title AS value, count(hits.id) AS count FROM docs_v d LEFT JOIN (SELECT id FROM hits) hits ON d.id = hits.id
               GROUP BY ALL"""
        ),
        "facet_year": over_hits(facet.format(c="CAST(year AS VARCHAR)", k=50)),
        "facet_rating": over_hits(
            """SELECT low AS bucket_start, low + 3.0 AS bucket_end, (SELECT count(*) FROM hits WHERE author_rating >= low AND author_rating < low + 3) AS count
               FROM (VALUES (CAST(1 AS DOUBLE)), (4), (7)) AS b(low)"""
        ),
        "facet_sentiment": _with_more(
            """SELECT CASE predicted WHEN 1 THEN 'POSITIVE' ELSE 'NEGATIVE' END AS value, count(*) AS count
               FROM scores JOIN labels ON id = 'rw' || doc_id, LATERAL (SELECT CASE WHEN doc_id % 7 = 0 THEN 1 - quality ELSE quality END AS predicted)
               GROUP BY ALL""",
            f"scores AS ({ONE})",
        ),
        "facet_multi": over_hits(
            """SELECT * FROM (SELECT field, value, count(*) AS count FROM (
                 SELECT 'movie_title' AS field, movie_title AS value FROM hits UNION ALL SELECT 'year', CAST(year AS VARCHAR) FROM hits)
               GROUP BY ALL) QUALIFY row_number() OVER (PARTITION BY field ORDER BY count DESC, value) <= 10"""
        ),
        "tfidf_terms": query("SELECT review_id, term, round(weight, 6) AS weight FROM tfidf_v", "tfidf"),
        "fused_features": query(
            """SELECT review_id, false AS extra, term AS feature, round(weight, 6) AS value FROM tfidf_v
               UNION ALL SELECT 'rw' || doc_id, true, 'irony_label', 1.0 FROM documents WHERE doc_id % 4 = 0
               UNION ALL SELECT 'rw' || doc_id, true, 'irony_score', CASE WHEN doc_id % 11 <> 0 THEN round((doc_id % 100) / 100.0, 6) END
               FROM documents WHERE doc_id % 11 = 0 OR doc_id % 100 <> 0""",
            "tfidf",
        ),
        **{
            f"score_{short}": query(
                f"""SELECT review_id, movie_id, '{model}' AS model, 'preprocessed_text' AS text_source,
                    TRUE AS is_share, TRUE AS label_fits FROM reviews_v""",
                "reviews",
            )
            for short, model in (("lr", "logistic_regression"), ("svm", "linear_svm"))
        },
        "score_corpus": query(
            f"""SELECT model, 'preprocessed_text' AS text_source, count(*) AS rows_scored, TRUE AS all_labelled, TRUE AS share_fits
                FROM reviews_v, ({MODELS}) GROUP BY model""",
            "reviews",
        ),
        "model_matrix": f"""SELECT text_source, model, TRUE AS are_shares
            FROM (VALUES ('preprocessed_text'), ('augmented_text')) AS s(text_source), ({MODELS})""",
        "score_dummy": query(
            f"""SELECT review_id, CASE {coin} WHEN 1 THEN 'POSITIVE' ELSE 'NEGATIVE' END AS predicted_label,
                CAST(0.5 AS DOUBLE) AS predicted_positive_probability FROM reviews_v""",
            "reviews",
        ),
    }
    return made | {"index_facets": made["facet_multi"]}
