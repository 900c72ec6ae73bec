"""Word lists that results depend on. All are defaults of parameters."""

POSITIVE = (
    "love", "excellent", "great", "fantastic", "amazing", "superb", "outstanding", "perfect",
    "wonderful", "brilliant", "best", "satisfied", "impressed", "recommend", "smooth", "quality",
    "happy", "delighted", "awesome", "nice", "good", "fast", "reliable", "helpful", "easy", "worth",
    "value", "pleased",
)

NEGATIVE = (
    "terrible", "horrible", "awful", "waste", "broke", "defective", "damaged", "disappointed",
    "misleading", "fake", "poor", "bad", "worst", "cheap", "unhelpful", "delayed", "useless",
    "broken", "frustrating", "annoying", "slow", "rude", "fail", "failure", "wrong", "issue",
    "problem", "return", "refund",
)

# Single tokens only: a phrase such as "far from" can never equal one token.
NEGATORS = (
    "not", "no", "never", "isn't", "wasn't", "aren't", "weren't", "don't", "doesn't", "didn't",
    "hardly", "barely", "nothing", "neither", "nor", "without", "lack", "lacking",
)

INTENSIFIERS = (
    "very", "extremely", "absolutely", "totally", "completely", "really", "so", "too", "quite",
    "highly",
)

# Negators that switch on the "negation detected" notice.
QUICK_NEGATORS = ("not", "no", "never", "isn't", "wasn't", "don't", "doesn't", "hardly", "barely")

# Substrings that make a short text acceptable as a review. A keyword that contains
# another one ("not good") adds nothing to a substring test.
REVIEW_KEYWORDS = (
    "positive", "negative", "neutral", "good", "bad", "great", "poor", "excellent", "terrible",
    "worst", "best", "amazing", "awful", "love", "hate", "okay", "ok", "fine", "decent", "average",
    "happy", "unhappy", "satisfied", "dissatisfied", "disappointed", "fast", "slow", "quick",
    "delayed", "broken", "defective", "quality", "delivery", "recommend", "return", "refund",
    "complaint", "perfect",
)

# Spark's own English stop words (StopWordsRemover); a test compares the two lists.
STOP_WORDS = (
    "i", "me", "my", "myself", "we", "our", "ours", "ourselves", "you", "your", "yours",
    "yourself", "yourselves", "he", "him", "his", "himself", "she", "her", "hers", "herself",
    "it", "its", "itself", "they", "them", "their", "theirs", "themselves", "what", "which",
    "who", "whom", "this", "that", "these", "those", "am", "is", "are", "was", "were", "be",
    "been", "being", "have", "has", "had", "having", "do", "does", "did", "doing", "a", "an",
    "the", "and", "but", "if", "or", "because", "as", "until", "while", "of", "at", "by", "for",
    "with", "about", "against", "between", "into", "through", "during", "before", "after",
    "above", "below", "to", "from", "up", "down", "in", "out", "on", "off", "over", "under",
    "again", "further", "then", "once", "here", "there", "when", "where", "why", "how", "all",
    "any", "both", "each", "few", "more", "most", "other", "some", "such", "no", "nor", "not",
    "only", "own", "same", "so", "than", "too", "very", "s", "t", "can", "will", "just", "don",
    "should", "now", "i'll", "you'll", "he'll", "she'll", "we'll", "they'll", "i'd", "you'd",
    "he'd", "she'd", "we'd", "they'd", "i'm", "you're", "he's", "she's", "it's", "we're",
    "they're", "i've", "we've", "you've", "they've", "isn't", "aren't", "wasn't", "weren't",
    "haven't", "hasn't", "hadn't", "don't", "doesn't", "didn't", "won't", "wouldn't", "shan't",
    "shouldn't", "mustn't", "can't", "couldn't", "cannot", "could", "here's", "how's", "let's",
    "ought", "that's", "there's", "what's", "when's", "where's", "who's", "why's", "would",
)
