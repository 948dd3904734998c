"""Fixed values that results depend on."""

# Fixed stop words of the tokeniser.
TOKEN_STOP_WORDS = [
    "a", "an", "and", "are", "as", "at", "be", "by", "for", "from", "has", "he", "in", "is", "it", "its", "of",
    "on", "that", "the", "to", "was", "will", "with", "this", "but", "they", "have", "had", "what", "when", "where",
    "who", "which", "why", "how",
]

# Fixed English stop words of the advanced cleaning mode (the public Snowball / NLTK list).
ENGLISH_STOP_WORDS = [
    "i", "me", "my", "myself", "we", "our", "ours", "ourselves", "you", "you're", "you've", "you'll", "you'd",
    "your", "yours", "yourself", "yourselves", "he", "him", "his", "himself", "she", "she's", "her", "hers",
    "herself", "it", "it's", "its", "itself", "they", "them", "their", "theirs", "themselves", "what", "which",
    "who", "whom", "this", "that", "that'll", "these", "those", "am", "is", "are", "was", "were", "be", "been",
    "being", "have", "has", "had", "having", "do", "does", "did", "doing", "a", "an", "the", "and", "but", "if",
    "or", "because", "as", "until", "while", "of", "at", "by", "for", "with", "about", "against", "between", "into",
    "through", "during", "before", "after", "above", "below", "to", "from", "up", "down", "in", "out", "on", "off",
    "over", "under", "again", "further", "then", "once", "here", "there", "when", "where", "why", "how", "all",
    "any", "both", "each", "few", "more", "most", "other", "some", "such", "no", "nor", "not", "only", "own",
    "same", "so", "than", "too", "very", "s", "t", "can", "will", "just", "don", "don't", "should", "should've",
    "now", "d", "ll", "m", "o", "re", "ve", "y", "ain", "aren", "aren't", "couldn", "couldn't", "didn", "didn't",
    "doesn", "doesn't", "hadn", "hadn't", "hasn", "hasn't", "haven", "haven't", "isn", "isn't", "ma", "mightn",
    "mightn't", "mustn", "mustn't", "needn", "needn't", "shan", "shan't", "shouldn", "shouldn't", "wasn", "wasn't",
    "weren", "weren't", "won", "won't", "wouldn", "wouldn't",
]

# Fixed order in which the keys of a JSON document are tried for its text.
JSON_TEXT_FIELDS = ["text", "content", "body", "description"]

# Fixed file suffixes a document may have.
SUPPORTED_FORMATS = [".pdf", ".docx", ".txt", ".json"]

# Fixed defaults for missing values.
UNKNOWN_FORMAT = "unknown"
UNASSIGNED_CLUSTER = -1

# Fixed corpus sizes up to which each milestone interval holds, then the interval beyond them.
MILESTONE_INTERVALS = [(50, 10), (200, 25), (500, 50), (1000, 100)]
MILESTONE_INTERVAL_BEYOND = 250

# Fixed mean speedup above which cluster-aware search counts as a significant gain.
SIGNIFICANT_SPEEDUP = 1.5

# Fixed label prefixes, tried in this order, with the words that trigger them.
TOPIC_PREFIXES = [
    ("Financial Documents", ["financial"]),
    ("Medical/Clinical", ["clinical", "medical"]),
    ("Legal Documents", ["legal"]),
]
