"""Word lists, lookup tables, patterns and limits that results depend on."""

# Survey questions and their codes.
QUESTION_CODES = {
    "What were the strengths of this course and/or this instructor?": "Q1",
    "What could the instructor do to make this course better?": "Q2",
    "Please expand on the instructor's strengths and/or areas for improvement in facilitating inclusive learning.": "Q3",
    "Please comment on your experience of the online course environment in the open-ended text box.": "Q4",
    "What I could have done to make this course better for myself.": "Q5",
}
UNKNOWN_QUESTION = "unknown"

# Term suffix to semester name.
SEMESTERS = {
    "10": "Fall",
    "30": "Spring",
    "40": "Summer 1",
    "50": "Summer Full",
    "60": "Summer 2",
}

# Weekdays in output order.
WEEKDAYS = ["monday", "tuesday", "wednesday", "thursday", "friday", "saturday", "sunday"]

# Pronouns that are neutralised, in replacement order.
PRONOUNS = ["he", "him", "his", "she", "her", "hers", "they", "them", "theirs"]
NEUTRAL_TERM = "the professor"

# Chart captions that leak into extracted page text.
CAPTION_PATTERNS = [
    "positive neutral negative.*?sentiment score",
    "percent of sentiment.*?sentiment score",
]

# The 32 ASCII punctuation characters.
PUNCTUATION = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"

# Characters a Unicode-aware strip removes.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

# Seed question templates.
SEED_TEMPLATES = [
    "What courses are being offered for the {semester} semester?",
    "Which professor is taking the course {course_name}?",
    "What courses do you recommend for the {semester} semester?",
    "What are the courses available related to {topic}?",
    "Can you suggest courses that take place on {day_of_week}?",
    "Can you suggest classes only after {time}?",
    "Can you please suggest online courses to take?",
    "Can you suggest research or seminar-based courses?",
    "Can you suggest courses without exams?",
    "Can you suggest courses which are not too hectic and easy to get good grades?",
    "What are the class timings for the course {course_name}?",
    "Are there any prerequisite courses for {course_name}?",
    "Has the course {course_name} been offered in the past? If so, could you summarize the reviews?",
    "Suggest a course with good reading materials (resources from the professor).",
    "What courses are being offered by Professor {professor_name}?",
]

# Topics for the {topic} placeholder.
TOPICS = [
    "Fundamentals of Computer Science",
    "Algorithms and Data Structures",
    "Object-Oriented Design",
    "Software Development",
    "Theory of Computation",
    "Data Science",
    "Artificial Intelligence",
    "Computer Systems",
    "Networks and Distributed Systems",
    "Game Programming",
    "Complex Network Analysis",
    "Health Informatics",
    "Robotics",
    "Statistical Methods",
    "Database Management Systems",
    "Computer Graphics",
    "Web Development",
    "Mobile Application Development",
    "Machine Learning",
    "Natural Language Processing",
    "Cybersecurity",
    "Information Visualization",
    "Programming Languages",
    "Compilers",
    "Software Engineering",
    "Operating Systems",
    "Computer Architecture",
    "Human-Computer Interaction",
]

# Evaluation question templates, one bucket each.
EVALUATION_TEMPLATES = [
    "What courses are being offered by {prof_name}?",
    "How are the reviews for {prof_name}?",
    "Are the classes taught by {prof_name} good?",
    "Is {prof_name} strict with their grading?",
    "What is the summary of the reviews for {prof_name}?",
    "Would you recommend {prof_name}?",
]

# Deployment texts; callers pass their own wording.
SYSTEM_INSTRUCTION = "You help students choose courses. Answer from the given context and do not speculate."
NO_CONTEXT_RESPONSE = "No relevant information was found for this question."

# Limits and thresholds.
TOP_K = 5
VECTOR_DIM = 768
CONTEXT_CHARS = 100_000
EVALUATION_CONTEXT_CHARS = 50_000
MESSAGE_CONTEXT_TOKENS = 9_000
THRESHOLD_BATCH = 4
DRIFT_UPPER_CUT = 0.1
DRIFT_LOWER_CUT = 0.6
DRIFT_WINDOW_DAYS = 7
DRIFT_MIN_ROWS = 2
PROPERTY_DRIFT = 0.25
DBSCAN_EPS = 0.7
DBSCAN_MIN_SAMPLES = 5
BIAS_HIGH = 4
BIAS_LOW = 2
BIAS_SAMPLE = 10
SPLIT_SHARE = 0.1
SPLIT_SEED = 29
EVALUATION_ROWS = 5
TRAINING_LIMIT = 50
SAMPLE_TARGET = 500
SAMPLES_PER_RUN = 50
GROWTH_RATIO = 0.1
