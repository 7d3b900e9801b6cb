"""They decide results, so they are stated here once and plainly."""

# Part-of-speech tags, in the column order of the feature table.
POS_TAGS = [
    "ADJ", "ADP", "ADV", "AUX", "CONJ", "CCONJ", "DET", "INTJ", "NOUN", "NUM",
    "PART", "PRON", "PROPN", "PUNCT", "SCONJ", "SYM", "VERB", "X", "SPACE",
]

# Tags that count as function words.
FUNCTION_TAGS = ["ADP", "AUX", "CONJ", "DET", "PART", "PRON", "SCONJ"]

# Class ids of the two text classifiers.
SENTIMENT_IDS = {"negative": 0, "positive": 1}
EMOTION_IDS = {"anger": 0, "fear": 1, "joy": 2, "sadness": 3}

# Markers an export appends to an edited message.
EDITED_MARKERS = ["<This message was edited>", "<Questo messaggio è stato modificato>"]
ATTACHED_MARKER = "(file attached)"

# Author of a record without author, and default name for unlisted authors.
INFO_AUTHOR = "info"
PLACEHOLDER = "other"

# Stamp formats of the two export dialects.
STAMP_BASE = r"\d{1,2}/\d{1,2}/\d{2,4}, \d{2}:\d{2}"
ANDROID_STAMP = STAMP_BASE + " - "
IOS_STAMP = r"\[" + STAMP_BASE + r":\d{2}\] "

# Accuracies that weight the two base models in the blended probability.
FEATURE_ACCURACY = 0.7
EMBEDDING_ACCURACY = 0.63

# Feature names, in configuration order, with their default switch.
FEATURE_SWITCHES = {
    "bag_of_words": True,
    "uppercase_count": True,
    "char_count": True,
    "word_length": True,
    "emoji_count": False,
    "unique_emoji_count": True,
    "sentiment": False,
    "emotion": False,
    "message_composition": True,
    "first_word_type": False,
    "englishness": True,
    "italianness": True,
    "responsiveness": False,
    "type_token_ratio": False,
    "simpsons_index": False,
    "swear_words": False,
    "common_words": False,
    "readability": False,
    "functional_words": False,
}

BAG_WIDTH = 2 ** 12
SEED = 42
EMBEDDING_STRATEGIES = ("mixed", "cls", "mean")
EMBED_BATCH = 32
EMBED_EPOCHS = 15
TRAINING_MODES = ("feature", "embeddings", "both", "meta")

# Search space of the meta learner.
SEARCH_SPACE = {
    "n_estimators": (50, 500),
    "max_depth": (3, 10),
    "learning_rate": (0.01, 0.3),
    "subsample": (0.6, 1.0),
    "colsample": (0.6, 1.0),
    "min_child_weight": (1, 10),
    "gamma": (0.0, 0.5),
    "reg_alpha": (0.0, 10.0),
    "reg_lambda": (0.1, 10.0),
}

# Certainty bands of a verdict.
BANDS = [(0.25, "Doubtful"), (0.5, "Probable")]
TOP_BAND = "Certain"

# Character classes, valid in Java and in RE2 alike. SPACE_CLASS is the set of
# characters at which Python's str.split() splits.
SPACE_CLASS = r"\t-\r\x{1c}-\x{20}\x{85}\p{Z}"
WORD_CLASS = r"\p{L}\p{N}_"
TOKEN_PATTERN = rf"\p{{L}}+|\p{{N}}+(?:[.,:]\p{{N}}+)*|[^{SPACE_CLASS}\p{{L}}\p{{N}}]"
BAG_TOKEN_PATTERN = rf"[{WORD_CLASS}]{{2,}}"
SENTENCE_END = [".", "!", "?", "…"]

# The code points that are emoji by themselves (Unicode's property Emoji, without digits, # and *)
_PICTOGRAPHS = (
    "A9 AE 203C 2049 2122 2139 2194-2199 21A9-21AA 231A-231B 2328 23CF 23E9-23F3 23F8-23FA 24C2 25AA-25AB 25B6 25C0 25FB-25FE 2600-2604 "
    "260E 2611 2614-2615 2618 261D 2620 2622-2623 2626 262A 262E-262F 2638-263A 2640 2642 2648-2653 265F-2660 2663 2665-2666 2668 267B "
    "267E-267F 2692-2697 2699 269B-269C 26A0-26A1 26A7 26AA-26AB 26B0-26B1 26BD-26BE 26C4-26C5 26C8 26CE-26CF 26D1 26D3-26D4 26E9-26EA "
    "26F0-26F5 26F7-26FA 26FD 2702 2705 2708-270D 270F 2712 2714 2716 271D 2721 2728 2733-2734 2744 2747 274C 274E 2753-2755 2757 "
    "2763-2764 2795-2797 27A1 27B0 27BF 2934-2935 2B05-2B07 2B1B-2B1C 2B50 2B55 3030 303D 3297 3299 1F004 1F0CF 1F170-1F171 1F17E-1F17F "
    "1F18E 1F191-1F19A 1F201-1F202 1F21A 1F22F 1F232-1F23A 1F250-1F251 1F300-1F321 1F324-1F393 1F396-1F397 1F399-1F39B 1F39E-1F3F0 "
    "1F3F3-1F3F5 1F3F7-1F4FD 1F4FF-1F53D 1F549-1F54E 1F550-1F567 1F56F-1F570 1F573-1F57A 1F587 1F58A-1F58D 1F590 1F595-1F596 "
    "1F5A4-1F5A5 1F5A8 1F5B1-1F5B2 1F5BC 1F5C2-1F5C4 1F5D1-1F5D3 1F5DC-1F5DE 1F5E1 1F5E3 1F5E8 1F5EF 1F5F3 1F5FA-1F64F 1F680-1F6C5 "
    "1F6CB-1F6D2 1F6D5-1F6D7 1F6DC-1F6E5 1F6E9 1F6EB-1F6EC 1F6F0 1F6F3-1F6FC 1F7E0-1F7EB 1F7F0 1F90C-1F93A 1F93C-1F945 1F947-1F9FF "
    "1FA70-1FA7C 1FA80-1FA89 1FA8F-1FAC6 1FACE-1FADC 1FADF-1FAE9 1FAF0-1FAF8"
).split()
_PICTOGRAPH = "[" + "".join("-".join(rf"\x{{{c}}}" for c in r.split("-")) for r in _PICTOGRAPHS) + "]"
_MODIFIED = _PICTOGRAPH + r"\x{FE0F}?[\x{1F3FB}-\x{1F3FF}]?"
# the longest first: flags of tags and of letters, keycaps, then pictographs with their marks and all that is joined to them
EMOJI_PATTERN = (
    r"\x{1F3F4}[\x{E0061}-\x{E007A}\x{E0030}-\x{E0039}]+\x{E007F}|[\x{1F1E6}-\x{1F1FF}]{2}|[0-9#*]\x{FE0F}?\x{20E3}|"
    + _MODIFIED + r"(?:\x{200D}" + _MODIFIED + r")*"
)

# Own default inputs, replaced by the user's files wherever one is given.
# A line that an app writes itself starts with a left-to-right mark, which people do not type; without it only
# the placeholders of media and of deleted messages count as notices, and only as the whole message.
NOTICE_PATTERNS = [
    r"\x{200E}.*",
    r"(?:image|video|audio|sticker|GIF|document) omitted",
    r"immagine omessa",
    r"<Media (?:omitted|omessi)>",
    r"This message was deleted",
    r"Questo messaggio è stato eliminato",
]

MILD_SWEAR_WORDS = ["damn", "hell", "crap", "bloody", "cavolo", "accidenti", "dannazione", "what the hell"]

ENGLISH_WORDS = [
    "the", "of", "and", "a", "to", "in", "is", "it", "you", "that", "he", "was", "for", "on", "are", "with", "as",
    "his", "they", "be", "at", "one", "have", "this", "from", "or", "had", "by", "not", "but", "what", "all",
]
ITALIAN_WORDS = [
    "il", "lo", "la", "i", "gli", "le", "di", "da", "con", "su", "per", "tra", "che", "non", "un", "una", "e", "è",
    "in", "a", "ma", "si", "come", "sono", "anche", "più", "ho", "ha",
]
COMMON_WORDS = sorted({*ENGLISH_WORDS, *ITALIAN_WORDS})

# Tag lexicon for frequent function words (lower case), own short default.
TAG_LEXICON = {
    "ADP": ["of", "in", "to", "for", "with", "on", "at", "by", "from", "di", "da", "con", "su", "per", "tra"],
    "AUX": ["is", "was", "are", "were", "be", "been", "has", "have", "had", "è", "sono", "era", "ha", "hanno"],
    "CCONJ": ["and", "or", "but", "e", "o", "ma"],
    "DET": ["the", "a", "an", "this", "il", "lo", "la", "gli", "le", "un", "una", "les", "une"],
    "PART": ["not", "non"],
    "PRON": ["it", "he", "she", "you", "we", "they", "who", "io", "tu", "lui", "lei", "noi", "voi", "che"],
    "SCONJ": ["that", "if", "because", "while", "as", "se", "perché", "mentre"],
    "ADV": ["there", "then", "very", "now", "molto", "poi", "ora"],
    "INTJ": ["oh", "ah", "ciao", "hello"],
}

# Word cues for lexicon scoring, own short defaults.
SENTIMENT_CUES = {
    "negative": ["bad", "sad", "hate", "awful", "worst", "brutto", "triste", "odio", "pessimo"],
    "positive": ["good", "love", "great", "nice", "best", "bene", "bello", "amore", "grazie"],
}
EMOTION_CUES = {
    "anger": ["hate", "angry", "rage", "furious", "odio", "rabbia"],
    "fear": ["fear", "afraid", "scared", "terrified", "paura", "terrore"],
    "joy": ["love", "joy", "happy", "glad", "felice", "gioia"],
    "sadness": ["sad", "cry", "lonely", "unhappy", "triste", "piangere"],
}
