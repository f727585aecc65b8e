"""Fixed word lists."""

# The classes, in the order of their index.
CLASSES = ("Fake", "Real", "Satire")

# Spark ML's default English stop words.
STANDARD_STOPWORDS = tuple("""
    i me my myself we our ours ourselves you your yours yourself yourselves
    he him his himself she her hers herself it its itself they them their
    theirs themselves what which who whom this that these those am is are
    was were be been being have has had having do does did doing a an the
    and but if or because as until while of at by for with about against
    between into through during before after above below to from up down in
    out on off over under again further then once here there when where why
    how all any both each few more most other some such no nor not only own
    same so than too very s t can will just don should now i'll you'll he'll
    she'll we'll they'll i'd you'd he'd she'd we'd they'd i'm you're he's
    she's it's we're they're i've we've you've they've isn't aren't wasn't
    weren't haven't hasn't hadn't don't doesn't didn't won't wouldn't shan't
    shouldn't mustn't can't couldn't cannot could here's how's let's ought
    that's there's what's when's where's who's why's would
""".split())

# Words the custom list takes out of the standard list.
STOPWORDS_KEPT = (
    "not", "no", "nor", "never", "very", "too", "most", "all", "only", "just",
    "more", "against", "between", "few", "own",
)

# Words the custom list adds.
STOPWORDS_ADDED = (
    "said", "also", "would", "could", "one", "new", "year", "time", "people",
    "may", "two", "first", "like", "get", "make",
)

# Romanised Urdu markers.
CODE_SWITCH_WORDS = (
    "kya", "hai", "nahi", "yeh", "woh", "koi", "aur", "bhi", "toh",
    "mein", "ko", "se", "ka", "ki", "ke", "par", "haan", "ji",
    "achha", "theek", "bohot", "zyada", "kam", "sab", "log",
    "kuch", "abhi", "phir", "lekin", "magar", "kyunke", "isliye",
    "sahi", "galat", "jhoot", "sach", "khabar", "mulk", "awam",
    "hukumat", "fauj", "siyasat", "wazir", "azam",
)

# Words whose incidence per class is reported.
NEGATION_WORDS = ("not", "no", "never", "completely", "false", "wrong")

# Statement ratings that count as Real and as Fake.
REAL_RATINGS = ("true", "mostly-true", "half-true")
FAKE_RATINGS = ("false", "pants-fire", "barely-true")

# Smoothing strengths of the sensitivity report.
ALPHAS = (0.01, 0.1, 0.5, 1.0, 2.0, 5.0)


def custom_stopwords() -> tuple[str, ...]:
    kept = [w for w in STANDARD_STOPWORDS if w not in STOPWORDS_KEPT]
    return tuple(kept + [w for w in STOPWORDS_ADDED if w not in kept])


def stopwords(kind: str = "custom") -> tuple[str, ...]:
    if kind == "standard":
        return STANDARD_STOPWORDS
    if kind == "custom":
        return custom_stopwords()
    raise ValueError(f"unknown stop word list: {kind}")
