"""Formats and names that results and messages must carry."""

# Analysis methods a task may ask for.
METHODS = ("POS", "CONSTITUENCY", "DEPENDENCY")

# Message types.
TYPE_NEW_JOB = "newTask"
TYPE_TASK = "urlParseRequest"
TYPE_TASK_RESULT = "urlParseResponse"
TYPE_JOB_DONE = "taskComplete"
TYPE_TERMINATE = "terminate"

# Failure texts in result rows.
ERR_METHOD = "Invalid parsing method: "
ERR_TIMEOUT = "Task Timed Out"
ERR_INTERRUPTED = "Worker Interrupted"
ERR_NO_DOCUMENT = "Document not found"  # our own wording
ERR_NOT_LOADED = "Annotator not loaded: "  # our own wording

# Key and link formats.
RESULTS_PREFIX = "workers-results"
REPLY_PREFIX = "local-app-output-"
INPUT_KEY = "input/%s/input.txt"
SUMMARY_KEY = "output/%s_summary.html"
CONSOLE_LINK = "https://s3.console.aws.amazon.com/s3/object/"
UNKNOWN = "unknown"

# Limits.
MAX_SENTENCE_TOKENS = 80
MAX_WORKERS = 10
IDLE_MINUTES = 30
VISIBILITY_MARGIN_S = 10
MIN_BUDGET_S = 10

# HTML escapes, in the order they apply.
HTML_ESCAPES = (
    ("&", "&amp;"),
    ("<", "&lt;"),
    (">", "&gt;"),
    ('"', "&quot;"),
    ("'", "&#39;"),
)

# Our own choice: English words of the closed classes of the Penn tag set.
CLOSED_CLASS = {
    "DT": ("a", "an", "the", "this", "that", "these", "those", "each", "every", "some", "any", "no", "all", "both"),
    "IN": (
        "about", "above", "after", "against", "among", "as", "at", "because", "before", "below", "between", "by",
        "during", "for", "from", "if", "in", "into", "of", "off", "on", "over", "since", "than", "through", "under",
        "until", "up", "while", "with", "without",
    ),
    "TO": ("to",),
    "CC": ("and", "but", "or", "nor", "yet", "so"),
    "PRP": ("i", "you", "he", "she", "it", "we", "they", "me", "him", "us", "them"),
    "PRP$": ("my", "your", "his", "her", "its", "our", "their"),
    "MD": ("can", "could", "may", "might", "must", "shall", "should", "will", "would"),
    "WP": ("who", "whom", "what"),
    "WDT": ("which",),
    "WRB": ("when", "where", "why", "how"),
    "EX": ("there",),
    "VBZ": ("is", "has", "does"),
    "VBP": ("are", "am", "have", "do"),
    "VBD": ("was", "were", "had", "did"),
    "VB": ("be",),
    "VBN": ("been", "done"),
    "RB": ("not", "very", "too", "also", "never", "always", "again"),
}

# Our own choice: suffix rules, first match wins.
SUFFIX_TAGS = (
    ("ing", "VBG"),
    ("ed", "VBD"),
    ("ly", "RB"),
    ("ous", "JJ"),
    ("ful", "JJ"),
    ("able", "JJ"),
    ("ible", "JJ"),
    ("ive", "JJ"),
    ("est", "JJS"),
    ("tion", "NN"),
    ("ment", "NN"),
    ("ness", "NN"),
    ("s", "NNS"),
)

# Our own choice: what an open-class word may be besides the tag its form tells.
ALSO_TAGS = {
    "NN": ("VB", "JJ"),
    "NNS": ("VBZ",),
    "VBG": ("NN",),
    "VBD": ("VBN", "JJ"),
    "RB": ("JJ",),
}

# Our own choice: relation of a token to its head, by tag, in shallow parses.
SHALLOW_RELATIONS = {
    "DT": "det",
    "IN": "case",
    "TO": "mark",
    "CC": "cc",
    "JJ": "amod",
    "JJS": "amod",
    "RB": "advmod",
    "MD": "aux",
    "PRP$": "poss",
    "CD": "nummod",
    "PUNCT": "punct",
}

# Our own choice: the kinds of leaves that the grammar sees instead of tags; other tags are of kind "O".
LEAF_KINDS = {
    "N": ("NN", "NNS", "NNP", "PRP", "CD", "EX", "WP"),
    "D": ("DT", "PRP$", "WDT"),
    "J": ("JJ", "JJS"),
    "V": ("VB", "VBZ", "VBP", "VBD", "VBG", "VBN", "MD"),
    "P": ("IN", "TO"),
    "R": ("RB", "WRB"),
    "C": ("CC",),
    "O": (),
}

# Our own choice: phrase labels, the first one preferred for a whole sentence.
PHRASES = ("S", "NP", "VP", "PP", "X")

# Our own choice: rules that the grammar believes in before it has seen text.
SEED_RULES = (
    ("S", "NP", "VP"), ("S", "S", "O"), ("S", "VP", "O"), ("S", "X", "S"),
    ("NP", "D", "N"), ("NP", "D", "NP"), ("NP", "J", "N"), ("NP", "J", "NP"), ("NP", "N", "N"), ("NP", "N", "NP"),
    ("NP", "NP", "PP"), ("NP", "NP", "X"),
    ("VP", "V", "NP"), ("VP", "V", "PP"), ("VP", "V", "VP"), ("VP", "VP", "PP"), ("VP", "R", "VP"), ("VP", "VP", "R"),
    ("PP", "P", "NP"), ("PP", "P", "N"),
    ("X", "C", "NP"), ("X", "C", "VP"), ("X", "C", "S"), ("X", "O", "NP"), ("X", "PP", "O"), ("X", "NP", "O"),
)

# Our own choice: phrases of a single leaf.
SEED_UNARY = (("NP", "N"), ("VP", "V"))

# Our own choice: how readily a kind of leaf heads another one; the higher kind heads the lower.
HEAD_RANK = {"V": 7, "N": 6, "P": 5, "J": 4, "R": 3, "D": 2, "C": 1, "O": 0}
