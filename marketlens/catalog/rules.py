"""Quality rules, de-duplication, feature extraction, joins and predicates."""

from pyspark.sql import functions as F

from marketlens import fixed_values as V
from marketlens.catalog.fixture import AS_OF
from marketlens.catalog.registry import POSTINGS, POSTINGS_AND_FEATURES, query, rounded, skills_text
from marketlens.catalog.reports import JOIN, LAST_30
from marketlens.functions import experience, location, remote, salary, skills, text
from marketlens.functions.roles import classify_role
from marketlens.operators import dedupe, features, near_duplicates, quality, rows, variants
from marketlens.plans import refresh
from marketlens.skills_seed import skill_rows

BOTH = POSTINGS_AND_FEATURES


def _listed(values) -> str:
    return ", ".join("'" + v.replace("'", "''") + "'" for v in values)


def _any_like(column: str, words) -> str:
    return "(" + " OR ".join(f"contains({column}, '{w}')" for w in words) + ")"


# Quality rules. NULL in a message reads None.

CITY_OK = f"""(coalesce(length(city), 0) >= 2 AND (city IN ({_listed(V.KNOWN_CITIES)})
  OR regexp_matches(city, '^[A-Za-zÀ-ÿ][A-Za-zÀ-ÿ\\s\\-''.]+$')))"""
SALARY_OK = """(CASE WHEN salary_min IS NULL AND salary_max IS NULL THEN TRUE
  WHEN salary_min IS NULL THEN salary_max BETWEEN 10000 AND 500000
  WHEN salary_max IS NULL THEN salary_min BETWEEN 10000 AND 500000
  ELSE salary_min <= salary_max AND salary_max >= 10000 AND salary_min BETWEEN 0 AND 500000
    AND salary_max <= 500000 AND NOT (salary_min > 0 AND salary_max > salary_min * 100) END)"""
URL_OK = """coalesce(regexp_matches(url, '^https?://') AND
  regexp_matches(url, 'https?://[a-zA-Z0-9\\-\\.]+\\.[a-zA-Z]{2,}'), FALSE)"""
COMPANY_OK = """coalesce(lower(company) NOT IN ('unknown', 'n/a', 'na') AND length(company) >= 2
  AND NOT regexp_matches(company, '^[0-9]+$'), FALSE)"""
REQUIRED_OK = "(" + " AND ".join(f"coalesce(CAST({c} AS VARCHAR), '') <> ''" for c in quality.REQUIRED) + ")"
ID_OK = "starts_with(job_id, source || '_')"
DATE_OK = "coalesce(date_diff('day', posted_date, DATE '2026-02-20') BETWEEN 0 AND 90, FALSE)"
# Fixed value: what marks a posting as spam.
SPAM = """regexp_matches(lower(concat(coalesce(title, 'None'), ' ', coalesce(company, 'None'), ' ',
  coalesce(description, 'None'))), 'work from home|make \\$\\d+|click here|limited time|act now|guaranteed|100% remote.*no experience')"""


def _none(column: str) -> str:
    return f"coalesce(CAST({column} AS VARCHAR), 'None')"


NARROW_SALARY_OK = SALARY_OK.replace(" 10000", " 30000").replace("500000", "250000")
NARROW_DATE_OK = DATE_OK.replace("90", "30")


def _issues(strict: bool, narrow: bool = False) -> str:
    salary_ok, date_ok = (NARROW_SALARY_OK, NARROW_DATE_OK) if narrow else (SALARY_OK, DATE_OK)
    rules = [
        (f"NOT {REQUIRED_OK}", "'Missing required fields'"),
        (
            f"province <> '' AND province NOT IN ({_listed(V.PROVINCE_CODES)})",
            "'Invalid province code: ' || province",
        ),
        (f"NOT {CITY_OK}", f"'Invalid city name: ' || {_none('city')}"),
        (
            f"NOT {salary_ok}",
            f"'Invalid salary range: ' || {_none('salary_min')} || ' - ' || {_none('salary_max')}",
        ),
        (f"NOT {date_ok}", "'Suspicious posted date: ' || coalesce(CAST(posted_date AS VARCHAR), '')"),
        (f"NOT {URL_OK}", f"'Invalid URL: ' || {_none('url')}"),
        ("length(title) NOT BETWEEN 3 AND 150", "'Invalid title length: ' || length(title)"),
        (f"NOT {COMPANY_OK}", f"'Invalid company name: ' || {_none('company')}"),
    ]
    if strict:
        rules.append((SPAM, "'Detected spam patterns'"))
    rules.append((f"NOT {ID_OK}", "'Job ID doesn''t match source: ' || job_id || ' vs ' || source"))
    cases = ", ".join(f"CASE WHEN {broken} THEN {message} END" for broken, message in rules)
    return f"array_to_string([x for x in [{cases}] if x IS NOT NULL], '; ')"


def _validated(strict: bool, narrow: bool = False) -> str:
    return f"""SELECT id, issues = '' AS is_valid, issues
    FROM (SELECT id, {_issues(strict, narrow)} AS issues FROM jobs_raw) v"""


def _shown_issues(checked):
    return checked.select("id", "is_valid", F.array_join("validation_issues", "; ").alias("issues"))


@query("dq_validate", _validated(False), POSTINGS)
def _(fx):
    return _shown_issues(quality.validate(fx.raw, AS_OF))


@query("dq9_validate_strict", _validated(True), POSTINGS)
def _(fx):
    return _shown_issues(quality.validate(fx.raw, AS_OF, strict=True))


@query("x3_validate_narrow_limits", _validated(False, narrow=True), POSTINGS)
def _(fx):
    return _shown_issues(quality.validate(fx.raw, AS_OF, limits=quality.NARROW_LIMITS))


def _rule(name: str, condition: str, build):
    @query(name, f"SELECT id, coalesce({condition}, FALSE) AS passes FROM jobs_raw", POSTINGS)
    def _(fx):
        return fx.raw.select("id", F.coalesce(build(F.col), F.lit(False)).alias("passes"))


_rule("dq1_required_fields", REQUIRED_OK, lambda c: quality.has_required_fields())
_rule(
    "dq2_province",
    f"(coalesce(province, '') = '' OR province IN ({_listed(V.PROVINCE_CODES)}))",
    lambda c: quality.valid_province(c("province")),
)
_rule("dq3_city", CITY_OK, lambda c: quality.valid_city(c("city")))
_rule(
    "dq4_salary_range", SALARY_OK,
    lambda c: quality.valid_salary_range(c("salary_min"), c("salary_max")),
)
_rule("dq5_posted_date", DATE_OK, lambda c: quality.recent_enough(c("posted_date"), AS_OF))
_rule("dq6_url", URL_OK, lambda c: quality.valid_url(c("url")))
_rule("dq7_title_length", "length(title) BETWEEN 3 AND 150", lambda c: quality.valid_title_length(c("title")))
_rule("dq8_company", COMPANY_OK, lambda c: quality.valid_company(c("company")))
_rule("dq10_id_matches_source", ID_OK, lambda c: quality.id_matches_source())
_rule(
    "p8_collected_ok",
    f"({REQUIRED_OK} AND description IS NOT NULL AND {ID_OK})",
    lambda c: quality.collected_ok(),
)
_rule(
    "p9_title_has_role_word",
    "len(list_intersect(string_split(lower(title), ' '), ['data', 'analyst', 'qa', 'engineer'])) > 0",
    lambda c: quality.title_has_role_word(c("title"), ["Data Analyst", "QA engineer"]),
)


@query(
    "dq11_valid_rows",
    f"SELECT id, job_id FROM (SELECT *, {_issues(False)} AS issues FROM jobs_raw) v WHERE issues = ''",
    POSTINGS,
)
def _(fx):
    valid, _ = quality.split(quality.validate(fx.raw, AS_OF))
    return valid.select("id", "job_id")


@query(
    "dq11_invalid_rows",
    f"SELECT id, issues FROM (SELECT *, {_issues(False)} AS issues FROM jobs_raw) v WHERE issues <> ''",
    POSTINGS,
)
def _(fx):
    _, invalid = quality.split(quality.validate(fx.raw, AS_OF))
    return invalid.select("id", F.array_join("validation_issues", "; ").alias("issues"))


# De-duplication.

# Inside a class: the white space of Python's string methods, spelled for RE2.
RE2_WS = r"\t-\r\x{1c}-\x{20}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"


def _norm(column: str) -> str:
    trimmed = f"regexp_replace(lower({column}), '^[{RE2_WS}]+|[{RE2_WS}]+$', '', 'g')"
    kept = f"regexp_replace({trimmed}, '[^a-z0-9{RE2_WS}]+', '', 'g')"
    return f"coalesce(regexp_replace({kept}, '[{RE2_WS}]+', ' ', 'g'), '')"


def _first(source: str, key: str, order: str = "id") -> str:
    return f"""SELECT * FROM {source} QUALIFY row_number() OVER (PARTITION BY {key} ORDER BY {order}) = 1"""


CONTENT = f"md5({_norm('title')} || '::' || {_norm('company')} || '::' || {_norm('city')})"
D1 = _first("jobs_raw", "job_id")
D2 = _first(f"({D1}) d1", CONTENT)


@query("d1_exact_dedupe", f"SELECT id, job_id FROM ({D1}) d", POSTINGS)
def _(fx):
    return dedupe.drop_repeated_ids(fx.raw, ["id"]).select("id", "job_id")


@query("d2_content_dedupe", f"SELECT id, job_id, title, company, city FROM ({D2}) d", POSTINGS)
def _(fx):
    return dedupe.deduplicate(fx.raw, ["id"]).select("id", "job_id", "title", "company", "city")


@query(
    "d2_content_dedupe_of_documents",
    "SELECT doc_id FROM ("
    + _first("documents", f"md5({_norm('text')} || '::' || {_norm('source')} || '::' || {_norm('lang')})", "doc_id")
    + ") d",
)
def _(fx):
    documents = fx.table("documents")
    kept = dedupe.drop_repeated_content(
        documents, ["doc_id"], title="text", company="source", city="lang"
    )
    return kept.select("doc_id")


@query("d3_normalised_documents", f"SELECT doc_id, md5({_norm('text')}) AS norm_md5, length({_norm('text')}) AS norm_length FROM documents")
def _(fx):
    norm = text.normalise(F.col("text"))
    return fx.table("documents").select(
        "doc_id", F.md5(norm).alias("norm_md5"), F.length(norm).cast("long").alias("norm_length")
    )


CONTENTS = f"""SELECT {_norm('p_brand')} AS norm_company, {_norm('p_type')} AS norm_city,
  {_norm('p_name')} AS norm_title, min(p_partkey) AS first_id, count(*) AS postings
FROM part GROUP BY ALL"""


def _part_contents(fx):
    return near_duplicates.contents(
        fx.table("part"), "p_partkey", title="p_name", company="p_brand", city="p_type"
    )


@query("d4_contents", CONTENTS)
def _(fx):
    return _part_contents(fx)


@query(
    "d4_posting_contents",
    f"""SELECT p_partkey, {_norm('p_brand')} AS norm_company, {_norm('p_type')} AS norm_city,
      {_norm('p_name')} AS norm_title FROM part""",
)
def _(fx):
    return near_duplicates.posting_contents(
        fx.table("part"), "p_partkey", title="p_name", company="p_brand", city="p_type"
    )


@query("d5_near_contents_of_parts")
def _(fx):
    return near_duplicates.near_contents(_part_contents(fx))


@query("d5_near_contents_of_postings")
def _(fx):
    return near_duplicates.near_contents(near_duplicates.contents(fx.raw))


STORED = "SELECT job_id FROM jobs_raw WHERE source IN ('adzuna', 'indeed')"


@query("d6_not_stored", f"SELECT id, job_id FROM jobs_raw WHERE job_id NOT IN ({STORED})", POSTINGS)
def _(fx):
    stored = rows.existing_job_ids(fx.raw.where(F.col("source").isin("adzuna", "indeed")))
    return rows.not_stored(fx.raw, stored).select("id", "job_id")


@query(
    "d7_dedupe_report",
    f"""SELECT (SELECT count(*) FROM jobs_raw) AS total_jobs, (SELECT count(*) FROM ({D2}) d) AS unique_jobs,
      (SELECT count(*) FROM jobs_raw) - (SELECT count(*) FROM ({D2}) d) AS duplicates_removed""",
    POSTINGS,
)
def _(fx):
    return dedupe.dedupe_report(fx.raw, ["id"])


# Feature extraction, by patterns without the shortcuts of the Spark side.

TEXT = "lower(title) || ' ' || lower(description)"
# How years are written, alone and as ranges.
UNIT = r"\s*(?:years?|yrs?)"
RANGE = rf"(\d+)[\s\-]*(?:to|-)[\s\-]*(\d+){UNIT}"
SINGLES = [rf"(\d+)\+?{UNIT}", rf"minimum\s*(?:of\s*)?(\d+){UNIT}", rf"at least\s*(\d+){UNIT}"]


def _number(pattern: str, group: int) -> str:
    return f"TRY_CAST(regexp_extract(t, '{pattern}', {group}) AS INT)"


def _experience(end: int) -> str:
    low, high = _number(RANGE, 1), _number(RANGE, 2)
    cases = f"CASE WHEN {low} <= 30 AND {high} <= 30 THEN {low if end == 0 else high}"
    for pattern in SINGLES:
        n = _number(pattern, 1)
        cases += f" WHEN {n} <= 30 THEN {n if end == 0 else f'least({n} + 3, 30)'}"
    return f"{cases} WHEN {_any_like('t', V.ENTRY_WORDS)} THEN {0 if end == 0 else 2} END"


def _skill_hit(name: str) -> str:
    """Unicode-aware word boundaries around one dictionary entry."""
    word = r"[\p{L}\p{N}_]"
    start = r"(?:^|[^\p{L}\p{N}_])"
    escaped = name.replace("+", r"\+")
    body = "node\\.?js" if name == "node.js" else escaped
    end = word if name[-1] in "+#" else r"(?:$|[^\p{L}\p{N}_])"
    return f"CASE WHEN regexp_matches(t, '{start}{body}{end}') THEN '{name.replace('.', '')}' END"


SKILLS = (
    "([x for x in [" + ", ".join(_skill_hit(s) for s in V.EXTRACTED_SKILLS) + "] if x IS NOT NULL])"
)
DETECTED = f"""CASE WHEN {_any_like('t', ['remote', 'work from home'])} THEN 'remote'
  WHEN {_any_like('t', ['hybrid', 'flexible work'])} THEN 'hybrid'
  WHEN regexp_matches(t, 'on[-\\s]?site|in[-\\s]?office|office based') THEN 'onsite' END"""
FULL_MEAN = "((coalesce(exp_min, 0) + coalesce(exp_max, exp_min, 0)) / 2.0)"
FALSY_MEAN = "((coalesce(exp_min, 0) + coalesce(nullif(exp_max, 0), nullif(exp_min, 0), 0)) / 2.0)"


def _level(mean: str) -> str:
    return f"""CASE WHEN exp_min IS NULL AND exp_max IS NULL THEN 'mid' WHEN {mean} <= 1 THEN 'entry'
      WHEN {mean} <= 3 THEN 'junior' WHEN {mean} <= 5 THEN 'mid' WHEN {mean} <= 8 THEN 'senior'
      ELSE 'lead' END"""


def _features(source: str) -> str:
    """Feature rows of a table with id, job_id, title, description, remote_type."""
    return f"""SELECT id, job_id, CAST(exp_min AS INT) AS exp_min, CAST(exp_max AS INT) AS exp_max,
      CAST({FULL_MEAN} AS DOUBLE) AS exp_avg, {_level(FALSY_MEAN)} AS exp_level, skills,
      CASE WHEN exp_min IS NULL AND exp_max IS NULL THEN FALSE ELSE {FULL_MEAN} <= 2 END AS is_junior,
      coalesce(kind IN ('remote', 'hybrid'), FALSE) AS is_remote
    FROM (SELECT id, job_id, {_experience(0)} AS exp_min, {_experience(1)} AS exp_max,
            {skills_text('found')} AS skills, coalesce(nullif(remote_type, ''), {DETECTED}) AS kind
          FROM (SELECT *, {SKILLS} AS found FROM (SELECT *, {TEXT} AS t FROM {source}) a) b) c"""


def _flat(df):
    return df.withColumn("exp_avg", F.col("exp_avg").cast("double")).withColumn(
        "skills", skills.skills_json(F.col("skills"))
    )


@query(
    "e9_extract_features",
    f"SELECT * EXCLUDE (id) FROM ({_features('(SELECT * FROM jobs_raw WHERE description IS NOT NULL) r')}) f",
    POSTINGS,
)
def _(fx):
    return _flat(features.extract_features(fx.raw))


def _lowered(fx):
    joined = F.concat(F.lower("title"), F.lit(" "), F.lower("description"))
    return fx.raw.select("id", "title", "remote_type", joined.alias("t"))


LOWERED = f"(SELECT id, title, remote_type, {TEXT} AS t FROM jobs_raw) l"


@query("e2_experience", f"SELECT id, CAST({_experience(0)} AS INT) AS exp_min, CAST({_experience(1)} AS INT) AS exp_max FROM {LOWERED}", POSTINGS)
def _(fx):
    exp = F.struct(experience.experience_range(F.col("t")).alias("exp"))
    return rows.with_parts(_lowered(fx), exp).select("id", "exp.exp_min", "exp.exp_max")


@query("e4_remote_type", f"SELECT id, {DETECTED} AS detected FROM {LOWERED}", POSTINGS)
def _(fx):
    return _lowered(fx).select("id", remote.remote_type_of_posting(F.col("t")).alias("detected"))


@query("e6_skills", f"SELECT id, {skills_text('found')} AS skills FROM (SELECT id, {SKILLS} AS found FROM {LOWERED} WHERE t IS NOT NULL) s", POSTINGS)
def _(fx):
    found = skills.extracted_skills(F.col("t"))
    return _lowered(fx).where("t IS NOT NULL").select("id", skills.skills_json(found).alias("skills"))


DOCUMENTS_LOWERED = "(SELECT doc_id, lower(text) AS t FROM documents) l"


@query("e6_skills_of_documents", f"SELECT doc_id, {skills_text('found')} AS skills FROM (SELECT doc_id, {SKILLS} AS found FROM {DOCUMENTS_LOWERED}) s")
def _(fx):
    lowered = fx.table("documents").select("doc_id", F.lower("text").alias("t"))
    found = skills.extracted_skills(F.col("t"))
    return lowered.select("doc_id", skills.skills_json(found).alias("skills"))


@query(
    "e7_levels_of_features",
    f"SELECT job_id, {_level(FALSY_MEAN)} AS exp_level FROM jobs_features", BOTH,
)
def _(fx):
    level = experience.exp_level(F.col("exp_min"), F.col("exp_max"))
    return fx.features.select("job_id", level.alias("exp_level"))


def _roles_sql() -> str:
    cases = " ".join(f"WHEN {_any_like('lower(title)', words)} THEN '{name}'" for name, words in V.ROLE_WORDS)
    return f"SELECT id, CASE {cases} ELSE 'Other' END AS role FROM jobs_raw"


@query("e8_role_category", _roles_sql(), POSTINGS)
def _(fx):
    return fx.raw.select("id", classify_role(F.col("title")).alias("role"))


@query(
    "k9_quarantined_features",
    f"SELECT job_id, exp_min, exp_max FROM ({_features('(SELECT * FROM jobs_raw WHERE description IS NOT NULL) r')}) f WHERE exp_max < exp_min",
    POSTINGS,
)
def _(fx):
    found = features.quarantined(features.extract_features(fx.raw))
    return found.select("job_id", "exp_min", "exp_max")


# The processing run: every second stored feature row already exists.

WAITING = """(SELECT * REPLACE (coalesce(description, '') AS description) FROM jobs_raw
  WHERE job_id NOT IN (SELECT job_id FROM jobs_features WHERE exp_level = 'mid')) w"""
VALID = f"(SELECT * EXCLUDE (issues) FROM (SELECT *, {_issues(False)} AS issues FROM {WAITING}) x WHERE issues = '') v"
KEPT = f"({_first('(' + _first(VALID, 'job_id') + ') k1', CONTENT)}) k2"
STORABLE = f"SELECT * EXCLUDE (id) FROM ({_features(KEPT)}) f WHERE coalesce(exp_max >= exp_min, TRUE)"


def _stored_features(fx):
    return fx.features.where(F.col("exp_level") == "mid")


@query("process_features", STORABLE, BOTH)
def _(fx):
    return _flat(refresh.processed_features(fx.raw, _stored_features(fx), AS_OF))


@query(
    "process_report",
    f"""SELECT (SELECT count(*) FROM {WAITING}) AS found, (SELECT count(*) FROM {VALID}) AS valid,
      (SELECT count(*) FROM {WAITING}) - (SELECT count(*) FROM {VALID}) AS invalid,
      (SELECT count(*) FROM {KEPT}) AS unique_jobs, (SELECT count(*) FROM ({STORABLE}) s) AS stored""",
    BOTH,
)
def _(fx):
    return refresh.process_report(fx.raw, _stored_features(fx), AS_OF)


@query(
    "o4_process_first_rows",
    """SELECT id FROM jobs_raw WHERE job_id NOT IN (SELECT job_id FROM jobs_features)
    ORDER BY id LIMIT 100""",
    BOTH,
)
def _(fx):
    return refresh.to_process(fx.raw, fx.features, limit=100).select("id")


# Joins and predicates on their own.


@query("j3_unprocessed", "SELECT id, job_id FROM jobs_raw WHERE job_id NOT IN (SELECT job_id FROM jobs_features)", BOTH)
def _(fx):
    return rows.unprocessed(fx.raw, fx.features).select("id", "job_id")


@query("j5_exploded_skills", "SELECT job_id, unnest(skills) AS skill FROM jobs_features", BOTH)
def _(fx):
    return rows.explode_skills(fx.features.select("job_id", "skills")).select("job_id", "skill")


@query("s17_existing_job_ids", "SELECT job_id FROM jobs_raw WHERE source = 'jsearch'", POSTINGS)
def _(fx):
    return rows.existing_job_ids(fx.raw, "jsearch")


@query("p1_salary_mid", "SELECT id, salary_mid FROM jobs_raw", POSTINGS)
def _(fx):
    mid = salary.salary_mid(F.col("salary_min"), F.col("salary_max"))
    return fx.raw.select("id", mid.alias("salary_mid"))


@query(
    "p1_generated_experience",
    "SELECT job_id, CAST(exp_avg AS DOUBLE) AS exp_avg, is_junior FROM jobs_features", BOTH,
)
def _(fx):
    made = features.with_generated(fx.features.select("job_id", "exp_min", "exp_max"))
    return made.select("job_id", F.col("exp_avg").cast("double").alias("exp_avg"), "is_junior")


@query(
    "p3_plausible_salary",
    """SELECT id FROM jobs_raw WHERE (salary_min IS NULL AND salary_max IS NULL)
      OR coalesce(salary_max, salary_mid) >= 10000""",
    POSTINGS,
)
def _(fx):
    keep = salary.plausible(F.col("salary_min"), F.col("salary_max"), F.col("salary_mid"))
    return fx.raw.where(keep).select("id")


@query(
    "p10_has_all_skills",
    "SELECT job_id FROM jobs_features WHERE list_has_all(skills, ['python', 'sql'])", BOTH,
)
def _(fx):
    return fx.features.where(skills.has_all_skills(F.col("skills"), ["python", "sql"])).select("job_id")


@query(
    "p15_province_names",
    "SELECT id, CASE province "
    + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in V.PROVINCE_NAMES.items())
    + " ELSE province END AS province_name FROM jobs_raw",
    POSTINGS,
)
def _(fx):
    return fx.raw.select("id", location.province_name(F.col("province")).alias("province_name"))


@query(
    "p16_plain_predicates",
    f"""SELECT id FROM {JOIN} WHERE salary_mid BETWEEN 30000 AND 90000 AND city IN ('Toronto', 'Regina')
      AND title LIKE '%Data%' AND exp_min IS NOT NULL AND is_junior AND {LAST_30}""",
    BOTH,
)
def _(fx):
    from marketlens.plans.market import recent_with_features

    c = F.col
    return (
        recent_with_features(fx.raw, fx.features, AS_OF, 30)
        .where(c("salary_mid").between(30000, 90000) & c("city").isin("Toronto", "Regina"))
        .where(c("title").like("%Data%") & c("exp_min").isNotNull() & c("is_junior"))
        .select("id")
    )


# Alternative rule sets.

NUMBER = "format('{:,}', CAST(%s AS BIGINT))"


def _filled(c: str) -> str:
    return f"coalesce(CAST({c} AS VARCHAR), '') NOT IN ('', '0')"


def _scored() -> str:
    low, high = NUMBER % "salary_min", NUMBER % "salary_max"
    paid = f"({_filled('salary_min')} OR {_filled('salary_max')})"
    age = "date_diff('day', posted_date, DATE '2026-02-20')"
    errors = [
        *[(f"NOT {_filled(n)}", f"'Missing required field: {n}'") for n in variants.SCORED_REQUIRED],
        ("length(title) < 3", "'Title too short: ' || length(title) || ' chars'"),
        ("length(city) <= 2", "'Invalid or unknown city: ' || city"),
        (
            f"province <> '' AND upper(province) NOT IN ({_listed(V.PROVINCE_CODES)})",
            "'Invalid province code: ' || province",
        ),
        (f"{age} < 0", "'Future date: ' || CAST(posted_date AS VARCHAR)"),
        (f"{age} > 30", f"'Job too old: ' || {age} || ' days'"),
        (f"{paid} AND salary_min NOT BETWEEN 30000 AND 250000", f"'Unrealistic salary_min: $' || {low}"),
        (f"{paid} AND salary_max NOT BETWEEN 30000 AND 250000", f"'Unrealistic salary_max: $' || {high}"),
        ("salary_min > salary_max", f"'salary_min > salary_max: $' || {low} || ' > $' || {high}"),
        ("url NOT LIKE 'http%'", "'Invalid URL format: ' || url"),
    ]
    warnings = [
        ("length(description) BETWEEN 1 AND 49", "'Description too short: ' || length(description) || ' chars'"),
        (f"NOT {ID_OK}", "'Job ID doesn''t match source prefix: ' || job_id"),
    ]

    def messages(rules):
        return "[x for x in [" + ", ".join(f"CASE WHEN {b} THEN {m} END" for b, m in rules) + "] if x IS NOT NULL]"

    filled = " + ".join(f"CAST({_filled(n)} AS INT)" for n in variants.SCORED_OPTIONAL)
    return f"""SELECT id, errors, warnings, len(errors) = 0 AS is_valid,
      greatest(0.0::DOUBLE, least(100.0::DOUBLE, 100.0::DOUBLE - len(errors) * 10 - len(warnings) * 2
        + filled / 6.0::DOUBLE * 10.0::DOUBLE)) AS quality_score
    FROM (SELECT id, {messages(errors)} AS errors, {messages(warnings)} AS warnings, {filled} AS filled
          FROM jobs_raw) m"""


@query(
    "x1_quality_score",
    f"""SELECT id, array_to_string(errors, '; ') AS errors, array_to_string(warnings, '; ') AS warnings,
      is_valid, {rounded("quality_score", 4)} AS quality_score FROM ({_scored()}) s""",
    POSTINGS,
)
def _(fx):
    return variants.score_quality(fx.raw, AS_OF).select(
        "id", F.array_join("errors", "; ").alias("errors"), F.array_join("warnings", "; ").alias("warnings"),
        "is_valid", F.round("quality_score", 4).alias("quality_score"),
    )


@query(
    "x2_quality_statistics",
    f"""SELECT count(*) AS total_jobs, count(*) FILTER (is_valid) AS valid_jobs,
      count(*) FILTER (NOT is_valid) AS invalid_jobs,
      {rounded("100.0 * count(*) FILTER (is_valid) / count(*)", 4)} AS validation_rate,
      {rounded("avg(quality_score) FILTER (is_valid)", 4)} AS avg_quality_score,
      CAST(sum(len(errors)) AS BIGINT) AS total_errors, CAST(sum(len(warnings)) AS BIGINT) AS total_warnings
    FROM ({_scored()}) s""",
    POSTINGS,
)
def _(fx):
    found = variants.quality_statistics(variants.score_quality(fx.raw, AS_OF))
    return found.withColumns(
        {n: F.round(n, 4) for n in ("validation_rate", "avg_quality_score")}
    )


@query(
    "x2_top_errors",
    f"""SELECT string_split(error, ':')[1] AS error_type, count(*) AS occurrences
    FROM (SELECT unnest(errors) AS error FROM ({_scored()}) s) e
    GROUP BY error_type ORDER BY occurrences DESC, error_type LIMIT 5""",
    POSTINGS,
)
def _(fx):
    return variants.top_errors(variants.score_quality(fx.raw, AS_OF))


LEGAL_COMPANY = "trim(regexp_replace(lower(coalesce(company, '') || suffix), '( inc| ltd| corp| llc)\\.?$', ''))"


@query(
    "x4_legal_name_dedupe",
    "SELECT id FROM ("
    + _first(
        f"""(SELECT *, left(sha256(trim(replace(replace(lower(title || tail), ' - remote', ''), '/', ' '))
          || '|' || {LEGAL_COMPANY} || '|' || lower(city)), 16) AS key
          FROM (SELECT *, CASE id % 3 WHEN 0 THEN ' - Remote' ELSE '' END AS tail,
            CASE id % 4 WHEN 0 THEN ' Inc.' WHEN 1 THEN ' LTD' ELSE '' END AS suffix FROM jobs_raw) t) s""",
        "key",
    )
    + ") d",
    POSTINGS,
)
def _(fx):
    tail = F.when(F.col("id") % 3 == 0, " - Remote").otherwise("")
    suffix = F.when(F.col("id") % 4 == 0, " Inc.").when(F.col("id") % 4 == 1, " LTD").otherwise("")
    varied = fx.raw.withColumn("title", F.concat("title", tail)).withColumn(
        "company", F.concat(F.coalesce("company", F.lit("")), suffix)
    )
    return dedupe.drop_repeated_legal_names(varied, ["id"]).select("id")


OPEN_TEXT = "lower(coalesce(description, '')) || ' ' || lower(title)"
OPEN_RANGE = rf"(\d+)\s*(?:to|-|–)\s*(\d+){UNIT}"
OPEN_SINGLES = [
    rf"(\d+)\+{UNIT}", rf"minimum\s+(?:of\s+)?(\d+){UNIT}", rf"at\s+least\s+(\d+){UNIT}",
    rf"(\d+){UNIT}\s+(?:of\s+)?experience",
]


def _open_experience(end: int) -> str:
    cases = f"CASE WHEN {_any_like('t', variants.OPEN_ENTRY_WORDS)} THEN {end}"
    cases += f" WHEN {_number(OPEN_RANGE, 1)} IS NOT NULL THEN {_number(OPEN_RANGE, end + 1)}"
    for pattern in OPEN_SINGLES:
        n = _number(pattern, 1)
        cases += f" WHEN {n} IS NOT NULL THEN {n if end == 0 else 'NULL'}"
    return f"CAST({cases} END AS INT)"


@query(
    "x5_open_features",
    f"""SELECT *, remote_type <> 'onsite' AS is_remote FROM (
      SELECT job_id, exp_min, exp_max,
        CASE WHEN {_any_like('title', variants.OPEN_SENIOR_WORDS)} THEN 'senior'
          WHEN {_any_like('title', variants.OPEN_ENTRY_WORDS)} THEN 'entry'
          WHEN exp_min = 0 THEN 'entry' WHEN exp_min <= 2 THEN 'junior' WHEN exp_min <= 5 THEN 'mid'
          WHEN exp_min <= 8 THEN 'senior' WHEN exp_min > 8 THEN 'lead' ELSE 'mid' END AS exp_level,
        CASE WHEN {_any_like('t', variants.OPEN_REMOTE_WORDS)} THEN 'remote'
          WHEN {_any_like('t', variants.OPEN_HYBRID_WORDS)} THEN 'hybrid' ELSE 'onsite' END AS remote_type
      FROM (SELECT job_id, lower(title) AS title, t, {_open_experience(0)} AS exp_min, {_open_experience(1)} AS exp_max
            FROM (SELECT job_id, title, {OPEN_TEXT} AS t FROM jobs_raw) a) b) c""",
    POSTINGS,
)
def _(fx):
    return variants.extract_open_features(fx.raw)


def _dictionary_sql() -> str:
    hits = []
    for name in sorted({n for n, *_ in skill_rows()}):
        word, edge = r"[\p{L}\p{N}_]", r"(?:^|$|[^\p{L}\p{N}_])"
        start = word if not name[0].isalnum() else edge
        end = word if not name[-1].isalnum() else edge
        body = "".join("\\" + ch if ch in "+.#/-" else ch for ch in name)
        hits.append(f"CASE WHEN regexp_matches(t, '{start}{body}{end}') THEN '{name}' END")
    found = "[x for x in [" + ", ".join(hits) + "] if x IS NOT NULL]"
    return f"""SELECT id, array_to_string(found, '; ') AS skills
    FROM (SELECT id, {found} AS found FROM (SELECT id, lower(coalesce(description, '')) AS t FROM jobs_raw) a) b"""


@query("x6_dictionary_skills", _dictionary_sql(), POSTINGS)
def _(fx):
    lowered = fx.raw.select("id", F.lower(F.coalesce("description", F.lit(""))).alias("t"))
    found = variants.dictionary_skills(F.col("t"), [name for name, *_ in skill_rows()])
    return lowered.select("id", F.array_join(found, "; ").alias("skills"))
