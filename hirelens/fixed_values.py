"""These must stay as they are, results depend on every one of them."""

# Money.
USD_TO_VND = 24_000
MILLION = 1_000_000
HIGH_SALARY_VND = 10_000_000
CURRENCY = "VND"
NEGOTIABLE = ["thoả thuận", "thỏa thuận"]

# Salary bands of the job search, [low, high) in VND, in display order.
SALARY_BANDS = {
    "Dưới 5 triệu": (0, 5_000_000),
    "5 - 10 triệu": (5_000_000, 10_000_000),
    "10 - 20 triệu": (10_000_000, 20_000_000),
    "20 - 50 triệu": (20_000_000, 50_000_000),
    "Trên 50 triệu": (50_000_000, None),
}

# Texts that stand for "nothing given".
UNKNOWN = "Không rõ"
NOT_SCRAPED = "N/A"
NO_TEXT = "Không có"
NO_TITLE = "(no title)"

# Needles the predicates look for, all in lower case.
BIG_CITIES = ["hà nội", "ho chi minh", "hồ chí minh"]
NO_EXPERIENCE = "không yêu cầu"
ELSEWHERE = "nơi khác"
OTHER = "khác"
BLOCKED_PAGE = "just a moment"
BRAND_LINK = "/brand/"

# Deadline wording.
EXPIRES_IN = "hết hạn trong"
DAY, WEEK, MONTH = "ngày", "tuần", "tháng"
DEADLINE_PREFIX = "Hạn nộp hồ sơ: "

# Most postings taken per group in one crawl.
POSTINGS_PER_GROUP = 500

# Keywords in the headings of a posting page and the field each one fills.
INFO_LABELS = {"salary": "lương", "location": "địa điểm", "experience": "kinh nghiệm"}
DESCRIPTION_LABELS = {
    "working_time": "thời gian làm việc",
    "description": "mô tả công việc",
    "requirements": "yêu cầu ứng viên",
    "benefits": "quyền lợi",
    "work_location_detail": "địa điểm làm việc",
}

# The same for the second page layout.
SECOND_SECTION_LABELS = {"description": "mô tả công việc", "requirements": "yêu cầu công việc"}
SECOND_INFO_LABELS = {"experience": "số năm kinh nghiệm tối thiểu", "working_time": "ngày làm việc"}

# Style classes of the elements that hold a field, first and second page layout.
TITLE_CLASS = "job-detail__info--title"
INFO_CLASS = "job-detail__info--section"
INFO_KEY_CLASS = "job-detail__info--section-content-title"
INFO_VALUE_CLASS = "job-detail__info--section-content-value"
DESCRIPTION_CLASS = "job-description__item"
SECTION_CLASS = "job-description__item--content"
DEADLINE_CLASS = "job-detail__information-detail--actions-label"
SECOND_CLASSES = {
    "title": ("h1", "sc-ab270149-0 hAejeW"),
    "deadline": ("span", "sc-ab270149-0 ePOHWr"),
    "salary": ("span", "sc-ab270149-0 cVbwLK"),
    "location": ("div", "sc-a137b890-1 joxJgK"),
}
SECOND_BENEFIT_CLASS = "sc-c683181c-2 fGxLZh"

# The skill lexicon.
SKILL_LEXICON = [
    "Python", "Java", "C#", "C++", "Go", "Golang", "PHP", "Ruby", "Swift", "Kotlin", "TypeScript", "JavaScript",
    ".NET", ".NET Core", "Spring Boot", "FastAPI", "Flask", "Django", "Express.js", "NestJS", "Laravel", "Node.js",
    "React", "React Native", "Vue.js", "Next.js", "Angular", "HTML", "CSS", "SASS", "Bootstrap",
    "AWS", "Azure", "Google Cloud", "GCP", "Docker", "Kubernetes", "Terraform", "Ansible",
    "Jenkins", "GitLab CI", "GitFlow", "ArgoCD", "Prometheus", "Grafana", "Linux", "Shell",
    "SQL", "MySQL", "PostgreSQL", "MariaDB", "MongoDB", "Redis", "Elasticsearch", "Kafka", "RabbitMQ",
    "Hadoop", "Spark", "HBase", "Hive", "Big Data", "Airflow", "ETL",
    "Machine Learning", "Deep Learning", "TensorFlow", "PyTorch", "Scikit-learn", "AI", "GenAI",
    "Microservice", "SOA", "ESB", "Camel", "OpenShift", "Openshift", "RESTful", "GraphQL", "gRPC",
    "Agile", "Scrum", "Git", "CI/CD", "Tiếng Anh", "Communication", "Problem Solving", "Teamwork",
]
