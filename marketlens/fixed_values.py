"""Word lists, code tables and thresholds that results depend on."""

# The thirteen province and territory codes.
PROVINCE_CODES = [
    "ON", "BC", "AB", "SK", "MB", "QC", "NS", "NB", "NL", "PE", "NT", "NU", "YT",
]

# Display name per province code.
PROVINCE_NAMES = {
    "AB": "Alberta", "BC": "British Columbia", "MB": "Manitoba", "NB": "New Brunswick",
    "NL": "Newfoundland", "NS": "Nova Scotia", "NT": "N.W.T.", "NU": "Nunavut",
    "ON": "Ontario", "PE": "P.E.I.", "QC": "Quebec", "SK": "Saskatchewan", "YT": "Yukon",
}

# Province name to code, all thirteen.
PROVINCE_BY_FULL_NAME = {
    "ontario": "ON", "british columbia": "BC", "alberta": "AB",
    "saskatchewan": "SK", "manitoba": "MB", "quebec": "QC",
    "nova scotia": "NS", "new brunswick": "NB",
    "newfoundland and labrador": "NL", "prince edward island": "PE",
    "northwest territories": "NT", "nunavut": "NU", "yukon": "YT",
}

# Province name to code, the eight names of the short table.
PROVINCE_BY_SHORT_TABLE = {
    "ontario": "ON", "british columbia": "BC", "alberta": "AB",
    "saskatchewan": "SK", "manitoba": "MB", "quebec": "QC",
    "nova scotia": "NS", "new brunswick": "NB",
}

# Province name or code to code, as the aggregated search feed writes it.
PROVINCE_BY_STATE = {
    "ontario": "ON", "on": "ON",
    "british columbia": "BC", "bc": "BC",
    "alberta": "AB", "ab": "AB",
    "quebec": "QC", "qc": "QC", "québec": "QC",
    "manitoba": "MB", "mb": "MB",
    "saskatchewan": "SK", "sk": "SK",
    "nova scotia": "NS", "ns": "NS",
    "new brunswick": "NB", "nb": "NB",
    "newfoundland": "NL", "nl": "NL",
    "pei": "PE", "pe": "PE",
}

# Province or region name to code, as the area lists write it.
PROVINCE_BY_REGION = {
    "ontario": "ON", "on": "ON",
    "alberta": "AB", "ab": "AB",
    "british columbia": "BC", "bc": "BC", "b.c.": "BC",
    "quebec": "QC", "qc": "QC", "québec": "QC",
    "manitoba": "MB", "mb": "MB",
    "saskatchewan": "SK", "sk": "SK",
    "nova scotia": "NS", "ns": "NS",
    "new brunswick": "NB", "nb": "NB",
}

# Province lookup of the remote-work feed.
PROVINCE_BY_REMOTE_PART = {
    "ontario": "ON", "on": "ON", "alberta": "AB", "ab": "AB",
    "british columbia": "BC", "bc": "BC", "quebec": "QC", "qc": "QC",
}

# Province per city, fifteen cities.
PROVINCE_BY_CITY = {
    "toronto": "ON", "ottawa": "ON", "mississauga": "ON", "hamilton": "ON",
    "calgary": "AB", "edmonton": "AB",
    "vancouver": "BC", "victoria": "BC", "surrey": "BC",
    "saskatoon": "SK", "regina": "SK",
    "winnipeg": "MB",
    "montreal": "QC", "quebec city": "QC", "laval": "QC",
}

# Cities of the list above that the second syndication feed does not know.
CITIES_UNKNOWN_TO_SECOND_RSS = ["hamilton", "surrey", "laval"]

# City names accepted without looking at their spelling.
KNOWN_CITIES = [
    "Toronto", "Vancouver", "Calgary", "Ottawa", "Edmonton", "Montreal", "Montréal",
    "Winnipeg", "Saskatchewan", "Quebec", "Québec", "Halifax", "Victoria", "Regina",
    "St. John's", "Fredericton", "Charlottetown", "Whitehorse", "Yellowknife", "Iqaluit",
    "Mississauga", "Brampton", "Hamilton", "Surrey", "Laval", "London", "Markham",
    "Vaughan", "Kitchener", "Windsor", "Richmond", "Burnaby", "Waterloo", "Saskatoon",
    "Ayr", "Port Coquitlam", "Lethbridge",
]

# Phrases that mark a posting as spam (regular expressions).
SPAM_PATTERNS = [
    r"work from home",
    r"make \$\d+",
    r"click here",
    r"limited time",
    r"act now",
    r"guaranteed",
    r"100% remote[^\n]*no experience",
]

# Placeholder company names.
PLACEHOLDER_COMPANIES = ["unknown", "n/a", "na"]

# Salary, age and length limits of the quality rules.
MIN_ANNUAL_SALARY = 10000
MAX_ANNUAL_SALARY = 500000
MAX_POSTING_AGE_DAYS = 90
TITLE_LENGTH = (3, 150)
HOURS_PER_YEAR = 2080
PAY_PERIODS_PER_YEAR = 26

# Skills looked for in a posting, in reporting order.
EXTRACTED_SKILLS = [
    "python", "java", "javascript", "typescript", "c++", "c#", "golang", "rust",
    "react", "angular", "vue", "node.js", "express",
    "sql", "postgresql", "mysql", "mongodb", "redis", "elasticsearch",
    "aws", "azure", "gcp", "docker", "kubernetes", "terraform",
    "git", "jenkins", "ci/cd", "github actions",
    "pandas", "numpy", "scikit-learn", "tensorflow", "pytorch",
    "spark", "hadoop", "kafka", "airflow",
    "tableau", "power bi", "looker", "excel",
]
MAX_EXTRACTED_SKILLS = 10

# Words that mean zero to two years when no number is given.
ENTRY_WORDS = ["entry level", "junior", "graduate", "new grad", "intern"]
MAX_EXPERIENCE_YEARS = 30

# Upper bound of mean years per level; above the last one it is "lead".
LEVEL_LIMITS = [("entry", 1), ("junior", 3), ("mid", 5), ("senior", 8)]

# Seniority rank per level; anything else ranks 3.
LEVEL_RANK = {"entry": 1, "junior": 2, "mid": 3, "senior": 4, "lead": 5}

# Role category per title word, first hit wins.
ROLE_WORDS = [
    ("Data Scientist", ["data scientist", "machine learning", "ml engineer", "ai engineer"]),
    ("Data Engineer", ["data engineer", "data pipeline", "etl"]),
    ("Data Analyst", ["data analyst", "business analyst", "analytics"]),
    ("Software Engineer", ["software engineer", "software developer", "backend", "frontend", "full stack"]),
    ("DevOps Engineer", ["devops", "site reliability", "sre", "platform engineer"]),
    ("Security Engineer", ["security", "cybersecurity", "infosec"]),
    ("Web Developer", ["web developer", "web dev"]),
    ("Mobile Developer", ["mobile", "ios", "android"]),
    ("QA Engineer", ["qa", "quality assurance", "test", "sdet"]),
    ("Database Administrator", ["database", "dba"]),
]

# Cities of the entry-level finder.
FINDER_CITIES = ["Toronto", "Saskatoon", "Regina", "Calgary", "Edmonton", "Winnipeg", "Vancouver"]

# Limits of the run alerts.
ALERT_MIN_JOBS = 1800
ALERT_MAX_ERRORS = 50
ALERT_MIN_SUCCESS_RATE = 90.0
