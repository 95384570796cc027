"""Fixed values of the domain: vocabularies, codes and patterns that results depend on. No logic."""

from __future__ import annotations

# Campus codes in their canonical form, aliases, and bracket tags that stand for the default campus.
CAMPUS_CODES = ["UPD", "UPLB", "UPM", "UPOU", "UPV", "UPMin", "UPB", "UPC", "UPT", "UPP"]
CAMPUS_ALIASES = {"DILIMAN": "UPD", "UPDILIMAN": "UPD", "UP-DILIMAN": "UPD"}
CAMPUS_TAGS = ["REVIEW", "PREROG", "EMAIL", "HELP", "QUESTION", "ART", "UPX"]
DEFAULT_CAMPUS = "UPD"
#: Campus words that an unbracketed title must not begin with (one code is not among them).
LEADING_CAMPUS = ["UPD", "UPLB", "UPM", "UPOU", "UPV", "UPMin", "UPB", "UPC", "UPT"]
#: Upper-case campus to the university id of the roster; one campus has none.
UNIVERSITIES = {"UPD": "upd", "UPLB": "uplb", "UPM": "upm", "UPOU": "upou", "UPV": "upv", "UPMIN": "upmin", "UPB": "upb", "UPC": "upc", "UPT": "upt"}

# Names.
SURNAME_PARTICLES = ["de", "dela", "del", "delos", "delas", "dels", "di", "da", "do", "san", "santa", "santo", "los", "las", "von", "van", "der", "den", "st", "mac", "mc"]
PARTICLES_NEVER_ALONE = ["de", "di", "del", "dela", "delos", "delas", "dels", "da", "do", "los", "las", "der", "den"]
HONORIFICS = r"sir|ma'?am|mam|ms\.?|mr\.?|mrs\.?|mx\.?|prof\.?|professor|teacher|doc\.?|dr\.?"
HONORIFICS_OF_NAMES = HONORIFICS + r"|fr\.?"
LEADING_SECTION = r"^(?:\d+(?:\.\d+)?|[A-Z]{1,3}\d+|WFX?|WF[A-Z]|TH[XY]|MWF|TTH|UNDER|FOR)\s*[-–—:]?\s+"
TRAILING_NOISE = r"(?:\s+(?:e-?mail|pls+|please|prerog(?:ative)?|notes?|help|review|units?|section|online|hybrid|sync|async|f2f|lec|lab|classmate?s?|gmail|looking(?:\s+for)?))+\s*$"
JUNK_SURNAMES = (
    r"\d+(?:\.\d+)?|tba|tbd|n/?a|none|unknown|prerogative|units|classmates!?|gymnastics|support|philippine|demo|kas|philo|fil|eng|math|chem|bio|econ|speech|review|upx|psych|electives|"
    r"preenlistment|hinay|diliman|pls|done|e-?mail|venue|classroom|help|her|profs?|prerogs?|thoughts|allow|looking|finding|gmail|classmate?s?|suggestions?|thesis|validation|respondents?|canceled|cancelled"
)
NAME_CONNECTIVES = r"\b(?:and|&|/|or|vs\.?|reco|prerog|classmates|finding|buddy|looking|thoughts|venue|classroom)\b"

# Titles.
SECTION_TOKEN = r"WF[A-Z]{0,2}|TH[A-Z]{0,3}|TWH(?:FW)?|MWF|TTH|MW|[A-Z]\d{1,2}"
CLASSMATE_HUNT = r"\b(?:looking for|finding|lf)\b.*\bclassmates?\b|\bclassmates?\b.*\b(?:looking|finding|lf)\b"
META_HUNT = r"\b(?:looking for|thoughts on|help an iska|prerogable|allow prerogs?|profs? that allow)\b"
TITLE_JUNK_NAMES = [
    "classmates", "classmate", "looking", "finding", "math", "arts", "units", "professor", "tba", "gymnastics", "rhythmic", "done", "pls", "pahingi", "venue", "classroom",
    "email", "e-mail", "profs", "prof", "prerogs", "thoughts", "help", "her", "suggestions", "thesis", "validation",
]
COURSE_PHRASES = ["sa mga", "nakakuha", "anyone", "thoughts", "paano", "reco", "recommend", "looking for", "classmates"]

# Classification of texts.
DELETED = ["", "[deleted]", "[removed]"]
REVIEW_TERMS = (
    r"\b(?:unoable|vouch|goated|workload|grading|attendance|mabait|terror|lecture|lectures|exam|exams|quiz|quizzes|recit|recitation|take\s+(?:him|her|them|this)|took\s+(?:him|her|them)|avoid|recommended?|"
    r"strict|lenient|reqs|requirements|singko|pasado|bagsak|magturo|nagtuturo|open\s+notes|gclass|google\s+class|canvas|uvle|long\s+exam|finals|hands[\s-]?on|nagaadjust|deadline|1\.0|1\.25|1\.5|10/10|"
    r"chill\s+(?:prof|class|lang)|super\s+vouch|super\s+bait|best\s+profs?|fave\s+prof|got\s+an?\s+uno|dont\s+take|don't\s+take|light\s+workload|heavy\s+workload|magaling\s+magturo)\b"
)
REACTIONS = r"^(?:up|\+1|same|ditto|agree|following|lol|lmao|haha|hahaha|f|w|rip|ok|okay|thanks|ty|tysm|noted|following this)\.?$"
COURSE_CODE = r"^[A-Za-z]{2,4}\s*\d{1,3}(?:\.\d+)?\s*$"
REQUESTS = (
    r"\b(?:\blf\b|looking for|classmates?|kaklase|groupmate|penge|pasend|discord|\bgc\b|group chat|can i (?:have|get)|pm me|dm me|message me|e-?mails?|how (?:can|do) i prerog|accepts?\s+prerogs?|prerog\s+din|"
    r"need units|share (?:the )?(?:notes|reviewer)|nasa crs|meron na sa crs|waitlist(?:ing|ed)?|(?:can|may) i (?:also )?have (?:them|it)|hi classmate)\b"
)
ASKS = (
    r"\b(?:any (?:comments?|thoughts?|reviews?)|how (?:is|was|po) (?:he|she|this|the|ur|your)|has anyone taken|thoughts on (?:this|him|her)|can anyone review|experience with|is (?:he|she) unoable|"
    r"musta (?:po )?(?:grade|sya|siya))\b"
)
THANKS = r"^(?:thank|thanks|tysm|noted|following|ok(?:ay)?|hello|hi)[\s!,.]*|\b(?:papasok|pending pa|demand slot|see u sa class|thank you po|thank u sm)\b"

# Signal keywords by family and kind.
SIGNALS = {
    ("workload", "heavy"): ["heavy workload", "heavy", "so many requirements", "reqs", "demanding", "exhausting", "draining", "time-consuming", "time consuming", "paper-heavy", "reading-heavy", "readings", "lots of tasks", "overwhelming"],
    ("workload", "light"): ["light workload", "light", "manageable", "easy reqs", "chill", "minimal reqs", "few requirements", "low effort", "relaxed"],
    ("grading", "generous"): ["unoable", "1.0", "flat 1", "generous", "high grades", "easy uno", "line of 1", "uno", "gives uno", "fairly high"],
    ("grading", "fair"): ["fair grading", "fair", "transparent", "justified", "gives feedback"],
    ("grading", "strict"): ["strict grader", "hard grader", "low grades", "transmutations", "hard to get uno", "stingy", "kuripot", "zero uno", "difficult to pass"],
    ("attendance", "strict"): ["strict attendance", "checks attendance", "mandatory", "deductions for tardiness", "strict with attendance", "absence limit", "singko if absent"],
    ("attendance", "lenient"): ["optional attendance", "lenient attendance", "does not check attendance", "no attendance", "no deductions", "recorded sessions"],
    ("pedagogy", "engaging"): ["engaging", "passionate", "fun", "inspiring", "great professor", "best prof", "approachable", "kind", "caring", "understanding"],
    ("pedagogy", "clear"): ["clear", "explains well", "master of subject", "knowledgeable", "organized", "structured", "good ppt", "clear slides"],
}

# Passes of a progressive ingest (sort, query, posts, comments).
PASSES = [
    ("new", None, 100, 50),
    ("hot", None, 100, 50),
    ("top", None, 200, 100),
    ("rising", None, 50, 25),
    ("new", "Math", 100, 50),
    ("new", "Eng", 100, 50),
    ("new", "Fil", 100, 50),
    ("new", "Bio", 80, 40),
    ("new", "Chem", 80, 40),
    ("new", "Econ", 80, 40),
    ("new", "Speech", 80, 40),
    ("new", "KAS", 80, 40),
    ("new", "Psych", 80, 40),
]
