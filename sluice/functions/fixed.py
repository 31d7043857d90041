"""Results depend on these exact lists, patterns and rates. All are parameters of what uses them."""

import re

# ---- fixed values: skill vocabulary, canonical name -> further names
SKILLS = {
    "Python": [], "SQL": [], "Java": [], "JavaScript": ["js"], "TypeScript": [], "Go": ["golang"],
    "Rust": [], "C++": ["cpp"], "C#": ["c sharp", ".net", "dotnet"], "Scala": [], "R": [],
    "Kotlin": [], "Swift": [], "PHP": [], "Ruby": ["rails", "ruby on rails"], "Bash": ["shell scripting"],
    "Spark": ["pyspark", "apache spark"], "Kafka": ["apache kafka"], "Airflow": ["apache airflow"],
    "dbt": [], "Snowflake": [], "BigQuery": [], "Redshift": [], "Databricks": [], "Hadoop": [],
    "Flink": ["apache flink"], "ETL": ["elt", "data pipelines"], "Data Warehousing": ["data warehouse"],
    "PostgreSQL": ["postgres"], "MySQL": [], "MongoDB": [], "Redis": [], "Elasticsearch": ["opensearch"],
    "Cassandra": [], "DynamoDB": [],
    "Excel": [], "Tableau": [], "Power BI": ["powerbi"], "Looker": [], "pandas": [], "NumPy": [],
    "Statistics": ["statistical"], "A/B Testing": ["ab testing", "experimentation"],
    "Machine Learning": ["ML"], "Deep Learning": [], "PyTorch": [], "TensorFlow": [], "scikit-learn": ["sklearn"],
    "NLP": ["natural language processing"], "Computer Vision": [],
    "LLMs": ["llm", "large language models", "genai", "generative ai"],
    "RAG": ["retrieval augmented generation", "retrieval-augmented generation"], "MLOps": [],
    "AWS": ["amazon web services"], "GCP": ["google cloud"], "Azure": ["microsoft azure"],
    "Docker": [], "Kubernetes": ["k8s"], "Terraform": [], "CI/CD": ["ci cd", "continuous integration"],
    "Linux": [], "Git": ["github", "gitlab"], "Microservices": [], "REST APIs": ["rest api", "restful"],
    "GraphQL": [],
    "React": ["react.js", "reactjs"], "Node.js": ["nodejs"], "Angular": [], "Vue": ["vue.js"],
    "Next.js": ["nextjs"], "Django": [], "Flask": [], "FastAPI": [], "Spring": ["spring boot"],
    "iOS": [], "Android": [], "React Native": [], "Flutter": [],
    "Agile": ["scrum"], "System Design": [], "Security": ["cybersecurity", "infosec"],
    "Testing": ["unit testing", "QA", "test automation"],
}
#: Names matched with their case.
CASE_SENSITIVE = {"R", "Go", "ML", "QA", "ETL", "SQL", "Spring", "Excel", "Swift", "React", "Rust", "Flask"}

# ---- fixed values: titles
TECH_TITLE = (
    r"engineer|developer|programmer|data|analyst|scientist|machine learning|\bml\b|\bai\b|devops|"
    r"\bsre\b|cloud|architect|software|backend|back-end|frontend|front-end|full[- ]?stack|"
    r"\bqa\b|test|security|platform|infrastructure|mobile|ios|android"
)
TECH_TITLE_EXACT = r"\bIT\b"

# ---- fixed values: normalisation of keys
COMPANY_SUFFIX = r"\b(gmbh|inc|ltd|llc|pvt|private|limited|corp|co|ag|se|plc)\b\.?"
GENDER_TAG = r"\((m|w|f|d|x|all)(\s*/\s*(m|w|f|d|x))*\)|\b(m|f|w)/(m|f|w)/(d|x)\b"
#: Found in any lower-case text in which the tag is.
GENDER_START = r"\([mwfdxa]|[mfw]/[mfw]/[dx]"
HASHED_CHARS = 2000

# ---- fixed values: locations, in order of precedence
COUNTRIES = [
    ("IN", r"\bindia\b|bengaluru|bangalore|mumbai|delhi|gurgaon|gurugram|noida|hyderabad|pune|chennai|kolkata|ahmedabad"),
    ("US", r"\busa?\b|united states|america|new york|san francisco|california|texas|seattle|boston|chicago"),
    ("GB", r"\buk\b|united kingdom|england|london|manchester|scotland"),
    ("DE", r"germany|deutschland|berlin|munich|münchen|hamburg|frankfurt|cologne|köln|stuttgart|düsseldorf|leipzig|dresden|nuremberg|nürnberg|hannover|bremen|essen|dortmund|bonn|mannheim|karlsruhe"),
    ("CA", r"canada|toronto|vancouver|montreal"),
    ("NL", r"netherlands|amsterdam|rotterdam"),
    ("EU", r"\beurope\b|\bemea\b|\beu\b"),
    ("REMOTE", r"worldwide|anywhere|global|remote"),
]
REMOTE_WORDS = r"remote|work from home|wfh"

# ---- fixed values: employment kinds
EMPLOYMENT = {
    "full_time": "full_time", "full time": "full_time", "full-time": "full_time", "permanent": "full_time",
    "part_time": "part_time", "part time": "part_time", "part-time": "part_time",
    "contract": "contract", "freelance": "contract", "contractor": "contract",
    "internship": "internship", "intern": "internship", "praktikum": "internship", "working student": "part_time",
}

# ---- fixed values: money
CURRENCY_SIGNS = [("$", "USD"), ("€", "EUR"), ("£", "GBP"), ("₹", "INR")]
CURRENCY_WORDS = r"\b(USD|EUR|GBP|INR|CAD|AUD)\b"
AMOUNT = r"(\d+(?:[.,]\d+)*)\s*([kK])?"
PERIODS = [("hour", r"/\s*h(ou)?r|per hour|hourly|/h\b"), ("month", r"/\s*mo(nth)?|per month|monthly")]
USD_PER = {"USD": 1.0, "INR": 1 / 88.0, "EUR": 1.16, "GBP": 1.34, "CAD": 0.72, "AUD": 0.66}
PER_YEAR = {"year": 1, "month": 12, "hour": 2080}

# ---- fixed values: excerpts
HEADINGS = (
    r"requirement|qualification|you have|you bring|what you.?ll need|your profile|skills|experience with|"
    r"must have|nice to have|tech stack|we.?re looking for|anforderung|dein profil|ihr profil|das bringst du"
)
#: In lower case, one of these is in whatever holds a heading.
HEADING_PIECES = (
    "requirement", "qualification", "you have", "you bring", "ll need", "your profile", "skills", "experience with",
    "must have", "nice to have", "tech stack", "re looking for", "anforderung", "dein profil", "ihr profil", "das bringst du",
)
HEADING_WORTH, PARAGRAPH_GAP = 3, 2
PARAGRAPH_END = re.compile(r"\n\s*\n|\n(?=- )")

# ---- fixed values: HTML. What counts as a tag, the tags that start a line, and what the text is tidied by
TAG = r"<\s*/?\s*[a-zA-Z][^>]*>"
BLOCK_TAGS = ("p", "div", "br", "li", "ul", "ol", "h1", "h2", "h3", "h4", "tr")
TIDY = ((r"[ \t\xa0]+", " "), (r"\n\s*\n+", "\n\n"))

# ---- fixed values: enrichment
ROLE_FAMILIES = (
    "data_engineer", "data_scientist", "data_analyst", "ml_engineer", "backend", "frontend", "fullstack",
    "mobile", "devops_sre", "qa", "security", "it_support", "engineering_manager", "other",
)
SENIORITIES = ("intern", "junior", "mid", "senior", "lead", "unknown")
REMOTE_POLICIES = ("remote", "hybrid", "onsite", "unknown")
PROMPT_VERSION, JOBS_PER_CALL, JOBS_PER_RUN, TOKENS_PER_MINUTE = "v1", 4, 120, 7000
#: Tokens that an answer takes for a job; calls tried for a batch; seconds that a provider may ask to wait, that it is
#: taken to ask for if it doesn't say, and to wait after a lost connection, times the number of tries.
ANSWER_TOKENS, TRIES, LONGEST_WAIT, DEFAULT_WAIT, CONNECTION_WAIT = 120, 4, 120, 20, 5

# ---- fixed values: order of sources for duplicates
SOURCE_PRIORITY = {"adzuna_in": 1, "remotive": 2, "remoteok": 3}

# ---- fixed values: matching
SEMANTIC_WEIGHT, COVERAGE_PRIOR, CHUNK_CHARS, DOCUMENT_CHARS = 0.5, 2, 700, 700

# ---- fixed values: evaluation
LABELLED_CHARS = 200
