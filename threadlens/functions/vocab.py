"""Word lists, limits and labels that results depend on."""

# English stopwords plus the link vocabulary of scraped posts.
STOPWORDS = [
    "a", "about", "above", "after", "again", "against", "all", "am", "an", "and", "any", "are", "aren't", "as", "at",
    "be", "because", "been", "before", "being", "below", "between", "both", "but", "by", "can't", "cannot", "could",
    "couldn't", "did", "didn't", "do", "does", "doesn't", "doing", "don't", "down", "during", "each", "few", "for",
    "from", "further", "had", "hadn't", "has", "hasn't", "have", "haven't", "having", "he", "he'd", "he'll", "he's",
    "her", "here", "here's", "hers", "herself", "him", "himself", "his", "how", "how's", "i", "i'd", "i'll", "i'm",
    "i've", "if", "in", "into", "is", "isn't", "it", "it's", "its", "itself", "let's", "me", "more", "most",
    "mustn't", "my", "myself", "no", "nor", "not", "of", "off", "on", "once", "only", "or", "other", "ought", "our",
    "ours", "ourselves", "out", "over", "own", "same", "shan't", "she", "she'd", "she'll", "she's", "should",
    "shouldn't", "so", "some", "such", "than", "that", "that's", "the", "their", "theirs", "them", "themselves",
    "then", "there", "there's", "these", "they", "they'd", "they'll", "they're", "they've", "this", "those",
    "through", "to", "too", "under", "until", "up", "very", "was", "wasn't", "we", "we'd", "we'll", "we're", "we've",
    "were", "weren't", "what", "what's", "when", "when's", "where", "where's", "which", "while", "who", "who's",
    "whom", "why", "why's", "with", "won't", "would", "wouldn't", "you", "you'd", "you'll", "you're", "you've",
    "your", "yours", "yourself", "yourselves", "http", "https", "com", "reddit", "submitted", "link",
]

# Sentiment lexicon, 16 positive and 18 negative words.
POSITIVE = [
    "good", "great", "excellent", "awesome", "positive", "love", "like", "best", "happy", "success", "win",
    "support", "trust", "truth", "benefit", "safe",
]
NEGATIVE = [
    "bad", "worst", "terrible", "horrible", "negative", "hate", "dislike", "fail", "failure", "sad", "fraud", "scam",
    "danger", "fake", "die", "kill", "crime", "illegal",
]
LABEL_THRESHOLD = 0.05

# Question limits and the closers ignored after a final question mark.
MAX_WORDS, MAX_CHARS, MAX_TRAILING = 60, 350, 25
CLOSERS = " \"')}]"
# Placeholders of deleted or removed texts (two prefixes and one whole text, any case).
PLACEHOLDER = r"(?i)^\[(?:deleted|removed| removed by reddit \]$)"
# Marks of a syndicated submission tagline.
TAGLINE, TAGLINE_LINK = "submitted by", "[link]"

# Answer tiers in order of preference (match type, status, confidence).
TIERS = {
    1: ("direct_reply", "verified_direct_reply", 0.95),
    2: ("thread_sibling", "unverified_thread_sibling", 0.70),
    3: ("fallback_top_score", "unverified_fallback", 0.40),
}

# Keyword and entity counts.
MAX_KEYWORDS, MAX_ENTITIES = 7, 4

# Characters str.strip() and str.split() treat as whitespace, and the class of str word characters.
WHITESPACE = "".join(chr(c) for c in range(0x3001) if chr(c).isspace())
WORD_CLASS = r"[\p{L}\p{N}_]"
