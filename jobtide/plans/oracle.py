"""The catalog's queries in DuckDB SQL, to compare results with."""

import re

from jobtide.plans.catalog import PART_SKILLS, TEXT_SKILLS, VOCABULARY

_ID = """CASE WHEN {k} % 50 = 0 THEN 'test_' ELSE 'v_' END || CAST({k} AS VARCHAR)"""
_MOMENT = """CAST(CAST({d} AS DATE) AS VARCHAR) || 'T10:30:00+0300'"""
_RATE = """CASE upper({c}) WHEN 'USD' THEN 95.0 WHEN 'EUR' THEN 102.0 WHEN 'KZT' THEN 0.2
           ELSE 1.0 END"""

RAW = f"""raw AS (
    SELECT {_ID.format(k="o_orderkey")} AS id,
           CASE WHEN o_orderkey % 89 <> 0 THEN p_name END AS name,
           n_name AS city,
           CASE WHEN o_orderkey % 4 <> 0 THEN CAST(floor(o_totalprice) AS INTEGER) END AS pay_from,
           CASE WHEN o_orderkey % 3 <> 0
                THEN CAST(floor(o_totalprice) AS INTEGER) + CAST(o_orderkey % 1000 AS INTEGER)
                END AS pay_to,
           o_orderkey % 12 <> 0 AS has_salary,
           CASE WHEN o_orderkey % 12 <> 0 THEN
               CASE o_orderpriority WHEN '1-URGENT' THEN 'usd' WHEN '2-HIGH' THEN 'EUR'
                   WHEN '3-MEDIUM' THEN 'RUR' WHEN '4-NOT SPECIFIED' THEN 'KZT' END
               END AS currency,
           '<p>' || p_name || '</p>' || chr(10) || '<b>' || p_brand || '</b> &amp; ' || p_type
               AS description,
           CASE WHEN o_orderkey % 7 <> 0 THEN string_split(p_name, ' ') END AS key_skills,
           CASE WHEN o_orderkey % 97 = 1 THEN 'unknown'
                WHEN o_orderkey % 97 <> 0 THEN {_MOMENT.format(d="o_orderdate")}
                END AS published_at
    FROM orders
    LEFT JOIN part ON p_partkey = o_orderkey % (SELECT count(*) FROM part)
    LEFT JOIN customer ON c_custkey = o_custkey
    LEFT JOIN nation ON n_nationkey = c_nationkey
)"""

_BOUND = "nullif(CAST({b} AS DOUBLE), 0)"
_LOW, _HIGH = _BOUND.format(b="pay_from"), _BOUND.format(b="pay_to")
_SALARY = f"""TRY_CAST(trunc(coalesce(({_LOW} + {_HIGH}) / 2, {_LOW}, {_HIGH})
              * CAST({_RATE.format(c="currency")} AS DOUBLE)) AS INTEGER)"""

POSTINGS = f"""WITH {RAW}, postings AS (
    SELECT id AS vacancy_id, name AS title, city, {_SALARY} AS salary_rub,
           regexp_replace(description, '<[^>]+>', '', 'g') AS description,
           coalesce(key_skills, []) AS skills,
           TRY_CAST(substr(published_at, 1, 10) AS DATE) AS published_date
    FROM raw
)"""

REVISIONS = f"""revisions AS (
    SELECT {_ID.format(k="l_orderkey")} AS vacancy_id,
           p_name AS title,
           CAST(floor(l_extendedprice)
                * CASE l_returnflag WHEN 'A' THEN 95 WHEN 'N' THEN 102 ELSE 1 END AS INTEGER)
               AS salary_rub,
           string_split(p_name, ' ') AS skills,
           CAST(l_shipdate AS DATE) AS published_date
    FROM lineitem LEFT JOIN part ON p_partkey = l_partkey
), latest AS (
    SELECT * EXCLUDE (copy) FROM (
        SELECT *, row_number() OVER (
            PARTITION BY vacancy_id
            ORDER BY published_date DESC, salary_rub DESC, title DESC) AS copy
        FROM revisions)
    WHERE copy = 1
)"""

_SPACE = r"[\s\x0b\x1c-\x1f\x85\p{Z}]+"


def _holds(term: str) -> str:
    quoted = re.sub(r"([+.$])", r"\\\1", term.lower())
    pattern = rf"(^|[^\p{{L}}\p{{N}}]){quoted}([^\p{{L}}\p{{N}}]|$)"
    return f"regexp_matches(lower(text), '{pattern}')"


def _detected(term: str) -> str:
    return f"CASE WHEN {_holds(term)} THEN '{term}' END"


# A number spoils a row; see the catalog.
_TITLE = "CASE WHEN {n} % 5 <> 0 THEN title END"
_CITY = "CASE WHEN {n} % 7 = 0 THEN repeat('c', 101) ELSE city END"
_KEY = """CASE WHEN {n} % 11 = 0 THEN rpad(vacancy_id, 51, 'x')
          WHEN {n} % 13 <> 0 THEN vacancy_id END"""
_NUMBER = "CAST(regexp_extract(vacancy_id, '[0-9]+') AS BIGINT)"


def _paid(currency: str, rate: int, times: int) -> str:
    return f"""
            SELECT id AS vacancy_id, name AS title, CAST(NULL AS VARCHAR) AS city,
                   CAST(pay_to * {times} * {rate} AS INTEGER) AS salary_rub,
                   TRY_CAST(substr(published_at, 1, 10) AS DATE) AS published_date
            FROM raw WHERE currency = '{currency}' AND name IS NOT NULL"""


def _merged(*batches: str) -> str:
    """Stored postings with batches put in; no two of these share a key."""
    names = [f"batch{i}" for i in range(len(batches))]
    made = "".join(f", {n} AS ({b})" for n, b in zip(names, batches, strict=True))
    left = "".join(f" AND vacancy_id NOT IN (SELECT vacancy_id FROM {n})" for n in names)
    added = "".join(
        f" UNION ALL SELECT vacancy_id, title, city, salary_rub, published_date FROM {n}"
        for n in names
    )
    return f"""{POSTINGS}{made}
        SELECT vacancy_id, title, city, salary_rub, published_date FROM postings
        WHERE title IS NOT NULL{left}{added}"""


_VERSIONS = f"""batch AS (
    SELECT CASE WHEN {_NUMBER} % 30 = 0 THEN 'new_' || vacancy_id ELSE vacancy_id END AS vacancy_id,
           CASE WHEN NOT ({_NUMBER} % 30 = 1 AND {_NUMBER} % 4 <> 0) THEN title END AS title, salary_rub,
           CASE WHEN {_NUMBER} % 30 = 1 AND {_NUMBER} % 4 = 0 THEN list_append(skills, NULL) ELSE skills END AS skills
    FROM postings WHERE {_NUMBER} % 30 < 3
)"""
_CHANGE = """CASE WHEN p.vacancy_id IS NULL THEN 'inserted'
    WHEN b.title IS NOT DISTINCT FROM p.title AND b.salary_rub IS NOT DISTINCT FROM p.salary_rub
        AND b.skills IS NOT DISTINCT FROM p.skills THEN 'unchanged' ELSE 'replaced' END"""


def _in(terms) -> str:
    return ", ".join(f"'{t}'" for t in terms)


ORACLE: dict[str, str] = {
    "daily_stats": f"""{POSTINGS}
        SELECT published_date, count(*) AS total_vacancies,
               CAST(round(avg(salary_rub)) AS INTEGER) AS avg_salary,
               count(DISTINCT city) AS cities_count
        FROM postings GROUP BY published_date
        ORDER BY published_date DESC NULLS FIRST""",
    "normalize_postings": f"""{POSTINGS}
        SELECT vacancy_id, title, city, salary_rub, description,
               array_to_string(skills, '|') AS skills, published_date
        FROM postings""",
    "salary_rub": f"WITH {RAW} SELECT id, {_SALARY} AS salary_rub FROM raw",
    "rate_join": f"WITH {RAW} SELECT id, {_SALARY} AS salary_rub FROM raw",
    "processing_stats": f"""{POSTINGS}
        SELECT count(*) AS total, count(salary_rub) AS with_salary FROM postings""",
    "with_salary": f"""{POSTINGS}
        SELECT vacancy_id, salary_rub FROM postings WHERE salary_rub IS NOT NULL""",
    "strip_html": """
        SELECT page_id, regexp_replace(html, '<[^>]+>', '', 'g') AS text FROM pages""",
    "skill_names": f"""WITH {RAW}
        SELECT id, CAST(len(coalesce(key_skills, [])) AS INTEGER) AS n_skills,
               array_to_string(coalesce(key_skills, []), '|') AS skills
        FROM raw""",
    "format_skills": rf"""
        WITH pieces AS (
            SELECT DISTINCT doc_id,
                   regexp_replace(piece, '^{_SPACE}|{_SPACE}$', '', 'g') AS piece
            FROM (SELECT doc_id, unnest(string_split(text, ',')) AS piece FROM documents)
        )
        SELECT doc_id,
               coalesce(string_agg(piece, '|' ORDER BY piece) FILTER (piece <> ''), '') AS skills
        FROM pieces GROUP BY doc_id""",
    "published_date": f"""{POSTINGS}
        SELECT vacancy_id AS id, published_date FROM postings""",
    "parse_timestamp": """
        SELECT event_id,
               epoch_us(CASE event_type
                   WHEN 'view' THEN date_trunc('second', ts)
                   WHEN 'click' THEN date_trunc('second', ts) - INTERVAL 3 HOUR
                   WHEN 'signup' THEN date_trunc('second', ts) + INTERVAL 330 MINUTE
                   WHEN 'purchase' THEN date_trunc('second', ts) - INTERVAL 3 HOUR
               END) AS epoch_us
        FROM events""",
    "first_number": """
        SELECT doc_id,
               TRY_CAST(regexp_extract(replace(replace(text, ',', ''), ' ', ''), '[0-9]+')
                        AS BIGINT) AS number
        FROM documents""",
    "detect_skills": f"""
        SELECT doc_id, concat_ws('|', {", ".join(_detected(t) for t in TEXT_SKILLS)}) AS skills
        FROM documents""",
    "skills_from_vocabulary": r"""
        WITH vocabulary AS (
            SELECT DISTINCT unnest(regexp_split_to_array(lower(text), '[^\p{L}\p{N}]+')) AS skill
            FROM benchmark
        ), words AS (
            SELECT DISTINCT doc_id,
                   unnest(regexp_split_to_array(lower(text), '[^\p{L}\p{N}]+')) AS skill
            FROM documents
        )
        SELECT doc_id, skill FROM words JOIN vocabulary USING (skill) WHERE skill <> ''""",
    "vocabulary_terms": " UNION ALL ".join(
        f"SELECT doc_id, '{t}' AS skill FROM documents WHERE {_holds(t)}" for t in VOCABULARY
    ),
    "validate_required": f"""WITH {RAW}
        SELECT id FROM raw WHERE name IS NOT NULL AND has_salary""",
    "validate_target": f"""{POSTINGS}
        SELECT vacancy_id, title, city FROM postings
        WHERE vacancy_id IS NOT NULL AND length(vacancy_id) <= 50
          AND title IS NOT NULL AND coalesce(length(city), 0) <= 100""",
    "rejected_postings": f"""{POSTINGS}, spoiled AS (
            SELECT {_KEY.format(n=_NUMBER)} AS vacancy_id, {_TITLE.format(n=_NUMBER)} AS title,
                   {_CITY.format(n=_NUMBER)} AS city
            FROM postings
        ), reasons AS (
            SELECT vacancy_id, concat_ws('|',
                CASE WHEN vacancy_id IS NULL THEN 'id missing' END,
                CASE WHEN length(vacancy_id) > 50 THEN 'id too long' END,
                CASE WHEN title IS NULL THEN 'title missing' END,
                CASE WHEN length(city) > 100 THEN 'city too long' END) AS reject_reasons
            FROM spoiled
        )
        SELECT vacancy_id, reject_reasons FROM reasons WHERE reject_reasons <> ''""",
    "clean_postings": f"""WITH {REVISIONS}
        SELECT vacancy_id, title, salary_rub, array_to_string(skills, '|') AS skills,
               published_date
        FROM (
            SELECT *, row_number() OVER (
                PARTITION BY vacancy_id
                ORDER BY published_date DESC, salary_rub DESC, title DESC) AS copy
            FROM revisions
            WHERE salary_rub % 5 <> 0 AND salary_rub % 7 <> 0 AND salary_rub % 11 <> 0
              AND salary_rub % 13 <> 0)
        WHERE copy = 1""",
    "latest_per_key": """
        SELECT user_id, event_id, event_type, value FROM (
            SELECT *, row_number() OVER (
                PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS copy
            FROM events)
        WHERE copy = 1""",
    "delete_where": f"""{POSTINGS}
        SELECT vacancy_id, title FROM postings WHERE NOT contains(vacancy_id, 'test_')""",
    "update_where": f"""{POSTINGS}
        SELECT vacancy_id,
               CASE WHEN vacancy_id = 'test_100' THEN 200000 ELSE salary_rub END AS salary_rub
        FROM postings""",
    "read_limit": f"""{POSTINGS}
        SELECT vacancy_id, salary_rub, published_date FROM postings
        ORDER BY vacancy_id LIMIT 10""",
    "append_new": f"{POSTINGS} SELECT vacancy_id, salary_rub FROM postings",
    "key_clashes": f"""{POSTINGS}, {REVISIONS}
        SELECT vacancy_id FROM revisions GROUP BY vacancy_id HAVING count(*) > 1
        UNION
        SELECT vacancy_id FROM postings
        WHERE NOT contains(vacancy_id, 'test_')
          AND vacancy_id IN (SELECT vacancy_id FROM revisions)""",
    "upsert": f"""{POSTINGS}, {REVISIONS}
        SELECT vacancy_id, title, city, salary_rub, array_to_string(skills, '|') AS skills,
               published_date
        FROM postings WHERE vacancy_id NOT IN (SELECT vacancy_id FROM latest)
        UNION ALL
        SELECT vacancy_id, title, NULL, salary_rub, array_to_string(skills, '|'), published_date
        FROM latest""",
    "upsert_unique": f"""{POSTINGS}
        SELECT vacancy_id, CASE WHEN {_NUMBER} % 3 <> 0 THEN title END AS title,
               CASE WHEN {_NUMBER} % 3 = 0 THEN salary_rub + 1 ELSE salary_rub END AS salary_rub
        FROM postings
        UNION ALL
        SELECT 'new_' || vacancy_id, title, salary_rub FROM postings WHERE {_NUMBER} % 3 = 0""",
    "upsert_changes": f"""{POSTINGS}, {_VERSIONS}
        SELECT b.vacancy_id, b.title, b.salary_rub, CAST(len(b.skills) AS INTEGER) AS n_skills, {_CHANGE} AS change
        FROM batch b LEFT JOIN postings p USING (vacancy_id)""",
    "upsert_counts": f"""{POSTINGS}, {_VERSIONS}
        SELECT count(*) FILTER (WHERE change = 'inserted') AS inserted, count(*) FILTER (WHERE change = 'replaced') AS replaced,
               count(*) FILTER (WHERE change = 'unchanged') AS unchanged
        FROM (SELECT {_CHANGE} AS change FROM batch b LEFT JOIN postings p USING (vacancy_id))""",
    "enrich": """
        SELECT doc_id, lang, source, quality, toxic FROM documents JOIN labels USING (doc_id)""",
    "missing_details": """
        SELECT doc_id, lang, source FROM documents
        WHERE doc_id NOT IN (SELECT doc_id FROM labels)""",
    "collection_rate": """
        SELECT listed, detailed, round(detailed / listed * 100, 1) AS rate_pct
        FROM (SELECT count(*) AS listed FROM documents),
             (SELECT count(*) AS detailed FROM labels)""",
    "union_pages": """
        SELECT c_name AS name, c_nationkey AS nation, c_acctbal AS balance,
               c_mktsegment AS segment
        FROM customer
        UNION ALL
        SELECT s_name, s_nationkey, s_acctbal, NULL FROM supplier""",
    "explode_items": """
        SELECT doc_id, item
        FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS item FROM documents)
        WHERE item <> ''""",
    "page_items": """
        SELECT p_partkey, '{"name":"' || word || '"}' AS item
        FROM (SELECT p_partkey, unnest(string_split(p_name, ' ')) AS word FROM part)""",
    "matches_query": """
        SELECT doc_id, lang FROM documents
        WHERE contains(lower(text), 'license') OR contains(lower(source), 'license')""",
    "published_since": f"""{POSTINGS}
        SELECT vacancy_id, published_date FROM postings
        WHERE published_date >= DATE '2001-08-01' - 30""",
    "cap": f"""{POSTINGS}
        SELECT vacancy_id, published_date, salary_rub FROM postings
        ORDER BY published_date DESC NULLS LAST, vacancy_id LIMIT 100""",
    "published_in_years": f"""{POSTINGS}
        SELECT vacancy_id, published_date FROM postings
        WHERE published_date >= DATE '2001-08-01' - 1500""",
    "cap_many": f"""{POSTINGS}
        SELECT vacancy_id, published_date, salary_rub FROM postings
        ORDER BY published_date DESC NULLS LAST, vacancy_id LIMIT 12000""",
    "count_by_day": f"""{POSTINGS}
        SELECT published_date, count(*) AS postings FROM postings GROUP BY published_date""",
    "salary_by_skill": f"""{POSTINGS}
        SELECT skill, count(*) AS postings, round(avg(salary_rub), 2) AS avg_salary
        FROM (SELECT salary_rub, unnest(list_distinct(skills)) AS skill FROM postings)
        WHERE skill IN ({_in(PART_SKILLS)}) GROUP BY skill""",
    "by_city": f"""{POSTINGS}
        SELECT city, count(*) AS postings,
               round(count(*) * 100.0 / (SELECT count(*) FROM postings), 2) AS share_pct
        FROM postings GROUP BY city""",
    "demand_trend": f"""{POSTINGS}, daily AS (
            SELECT CAST(day AS DATE) AS published_date, count(published_date) AS postings
            FROM (SELECT unnest(generate_series(min(published_date), max(published_date),
                                                INTERVAL 1 DAY)) AS day FROM postings)
            LEFT JOIN postings ON published_date = CAST(day AS DATE) GROUP BY day
        )
        SELECT published_date, postings,
               postings - lag(postings) OVER (ORDER BY published_date) AS change,
               round(avg(postings) OVER (ORDER BY published_date
                   ROWS BETWEEN 6 PRECEDING AND CURRENT ROW), 2) AS moving_avg
        FROM daily""",
    "skill_frequency": f"""{POSTINGS}
        SELECT skill, count(*) AS postings
        FROM (SELECT unnest(list_distinct(skills)) AS skill FROM postings)
        GROUP BY skill ORDER BY postings DESC, skill""",
    "read_raw": f"""
        SELECT {_ID.format(k="o_orderkey")} AS id, o_orderpriority AS name,
               CAST(floor(o_totalprice) AS INTEGER) AS salary_from
        FROM orders WHERE o_orderstatus <> 'P'""",
    "rejected_records": f"""
        SELECT {_ID.format(k="o_orderkey")} AS id,
               'record does not fit the schema' AS parse_error
        FROM orders WHERE o_orderstatus = 'P'""",
    "read_raw_array": f"""
        SELECT {_ID.format(k="o_orderkey")} AS id, o_orderpriority AS name,
               CAST(floor(o_totalprice) AS INTEGER) AS salary_from
        FROM orders WHERE o_orderstatus <> 'P'""",
    "read_raw_split": f"""
        SELECT {_ID.format(k="o_orderkey")} AS id, o_orderpriority AS name,
               CAST(floor(o_totalprice) AS INTEGER) AS salary_from
        FROM orders WHERE o_orderstatus <> 'P'""",
    "rejected_array": f"""
        SELECT CASE WHEN o_orderkey % 500 = 1 THEN CAST(o_orderkey AS VARCHAR)
                    ELSE {_ID.format(k="o_orderkey")} END AS id,
               'record does not fit the schema' AS parse_error
        FROM orders WHERE o_orderstatus = 'P' OR o_orderkey % 500 = 1""",
    "land_raw": f"""WITH {RAW}
        SELECT id, name,
               CASE WHEN has_salary THEN pay_to END AS salary_to,
               array_to_string(key_skills, '|') AS skills
        FROM raw""",
    "latest_batch": f"""
        SELECT {_ID.format(k="l_orderkey")} AS id, p_name AS name,
               CAST(floor(l_extendedprice) AS INTEGER) AS salary_from
        FROM lineitem LEFT JOIN part ON p_partkey = l_partkey""",
    "process_postings": f"""{POSTINGS}
        SELECT vacancy_id, title, city, salary_rub, published_date FROM postings
        WHERE title IS NOT NULL""",
    "ingest_postings": _merged(_paid("usd", 95, 2)),
    "keyed_snapshot": _merged(_paid("usd", 95, 2)),
    "ingest_two_sources": _merged(_paid("usd", 95, 2), _paid("EUR", 102, 3)),
    "ingest_array": _merged(),
    "daily_stats_kept": f"""
        SELECT published_date, count(*) AS total_vacancies, CAST(round(avg(salary_rub)) AS INTEGER) AS avg_salary,
               count(DISTINCT city) AS cities_count
        FROM ({_merged(_paid("usd", 95, 2), _paid("EUR", 102, 3))}) GROUP BY published_date""",
    "target_table": f"""{POSTINGS}, made AS (
            SELECT vacancy_id, title, salary_rub FROM postings WHERE title IS NOT NULL
            UNION ALL SELECT 'made_1', 'made', 150000
        )
        SELECT vacancy_id, title, salary_rub, (SELECT count(salary_rub) FROM made) AS n_paid,
               CAST((SELECT sum(salary_rub) FROM made) AS BIGINT) AS sum_paid
        FROM made""",
    "stats_view": f"""{POSTINGS}
        SELECT published_date, count(*) AS postings, max(salary_rub) AS most
        FROM postings GROUP BY published_date""",
    "z_ordered_postings": f"""{POSTINGS}
        SELECT vacancy_id, city, salary_rub, published_date, 'city' AS asked FROM postings WHERE city = 'GERMANY'
        UNION ALL
        SELECT vacancy_id, city, salary_rub, published_date, 'salary' AS asked FROM postings
        WHERE salary_rub BETWEEN 20000000 AND 30000000""",
    "bucket_clashes": f"""{POSTINGS}, batch AS (
            SELECT {_ID.format(k="l_orderkey")} AS vacancy_id FROM lineitem WHERE l_orderkey % 97 = 5
            UNION ALL SELECT vacancy_id FROM postings WHERE vacancy_id IN ('v_33', 'test_100')
        )
        SELECT vacancy_id FROM batch GROUP BY vacancy_id
        HAVING count(*) > 1 OR vacancy_id IN (SELECT vacancy_id FROM postings WHERE NOT contains(vacancy_id, 'test_'))""",
    "indexed_search": r"""
        SELECT doc_id, lang, CAST(n AS INTEGER) AS query FROM documents,
            (VALUES (0, '(^|[^\p{L}\p{N}])mit license($|[^\p{L}\p{N}])'), (1, '(^|[^\p{L}\p{N}])src7($|[^\p{L}\p{N}])'),
                    (2, '(^|[^\p{L}\p{N}])licensed under the($|[^\p{L}\p{N}])')) q(n, p)
        WHERE regexp_matches(lower(text), p) OR regexp_matches(lower(source), p)""",
    "even_slices": "SELECT count(*) AS rows, TRUE AS even FROM lineitem",
    "defaults": """
        SELECT event_id, event_id % 3 <> 0 AS kept, event_id % 3 = 0 AS filled FROM events""",
    "clustered_postings": f"""{POSTINGS}
        SELECT vacancy_id, city, salary_rub, published_date FROM postings
        WHERE published_date BETWEEN DATE '2001-06-15' AND DATE '2001-07-14'""",
}
