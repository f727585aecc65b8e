import pytest
from pyspark.sql import functions as F

from lexmill.functions import cleaning as C, tokenizers as K
from lexmill.functions.stemming import porter, snowball
from lexmill.functions.wordlists import CODE_SWITCH_WORDS, STANDARD_STOPWORDS, stopwords
from lexmill.operators import normalizing as N, tokenizing as T
from lexmill.operators.cleaning import clean_corpus


def one(spark, text, f):
    return spark.createDataFrame([(text,)], "t string").select(f(F.col("t")).alias("r")).first().r


@pytest.mark.parametrize("text, expected", [
    ("Update: <i>River</i> rises 'fast' http://x.org/1?a=b @gauge_7 #flood!!!",
     "update: river rises 'fast' !"),
    ("Really??? \U0001F621\U0001F621 WRITE to desk@paper.org now", "really? write to now"),
    ("up $2.5M (20% more)...", "up $2.5m (20% more)."),
    ("a -- b --- c", "a — b — c"),
    ("two words here", "two words here"),
    ("", ""), (None, ""),
])
def test_clean_text(spark, text, expected):
    assert one(spark, text, C.clean_text) == expected


def test_clean_text_aggressive(spark):
    clean = lambda c: C.clean_text(c, aggressive=True)
    assert one(spark, "In 2024 paid $1500 or 15% ~ 20245 2024 2025", clean) == \
        "in num paid num or percent num num num"
    assert one(spark, "cost $15.5 now -- ok", clean) == "cost money now ok"


def test_emails_on_long_runs(spark):
    text = "x" * 200_000 + " a@b.c end"
    assert one(spark, text, C.strip_emails) == "x" * 200_000 + "   end"
    assert one(spark, "@a.b @@b.c a@b", C.strip_emails) == "@a.b   a@b"


def test_emoji_strict_keeps_cjk(spark):
    assert one(spark, "ok 漢字", C.strip_emoji).strip() == "ok"
    assert one(spark, "ok 漢字", lambda c: C.strip_emoji(c, strict=True)) == "ok 漢字"


def test_clean_corpus_drops_short(spark):
    df = spark.createDataFrame([(1, "short"), (2, "long enough text")], "doc_id long, text string")
    assert [r.doc_id for r in clean_corpus(df).collect()] == [2]


@pytest.mark.parametrize("word, expected", [
    ("don't", ["do", "n't"]), ("won't", ["wo", "n't"]), ("I'm", ["I", "'m"]),
    ("they're", ["they", "'re"]), ("it's", ["it", "'s"]), ("can't", ["ca", "n't"]),
    ("shouldn't", ["should", "n't"]), ("cannot", ["can", "not"]), ("gonna", ["gon", "na"]),
    ("He said \"go home.\" Then left.",
     ["He", "said", "``", "go", "home", ".", "''", "Then", "left", "."]),
    ("U.S. costs $3.50, not 3,000!", ["U.S.", "costs", "$", "3.50", ",", "not", "3,000", "!"]),
])
def test_contractions(spark, word, expected):
    assert one(spark, word, K.tokenize_contractions) == expected


def test_contraction_accuracy(spark):
    cases = spark.createDataFrame([(w,) for w in ("don't", "won't", "I'm", "they're", "it's", "can't", "shouldn't")], "word string")
    row = T.contraction_accuracy(cases).first()
    assert (row.n_cases, row.contractions_accuracy, row.regex_accuracy) == (7, 1.0, 0.0)


def test_preservation(spark):
    # Fixed value: a code-switched sentence.
    text = "yeh news bilkul fake hai aur log pagal ho rahe hain"
    rate = lambda c: T.preservation_rate(c, F.array(*[F.lit(w) for w in text.split()]))
    assert one(spark, text, rate) == 1.0


def test_regex_tokens(spark):
    got = one(spark, "U.S.A. fact-check isn't 3.14 50% café!", K.tokenize_regex)
    assert got == ["U.S.A.", "fact-check", "isn't", "3", ".", "14", "50", "café", "!"]
    assert len(one(spark, "a-" * 50_000 + "a", K.tokenize_regex)) == 1


def test_vectorizer_tokens(spark):
    assert one(spark, "Fact-check a n't I Is_ok", K.tokenize_vectorizer) == ["fact", "check", "is_ok"]


def test_stopword_lists():
    custom = set(stopwords("custom"))
    assert len(STANDARD_STOPWORDS) == 181 and "not" not in custom and "said" in custom
    assert len(stopwords("custom")) == len(custom)
    assert len(set(CODE_SWITCH_WORDS)) == len(CODE_SWITCH_WORDS) == 44


def test_removal(spark):
    df = spark.createDataFrame([(["The", "cat", "is", "not", "THE"],), ([],)], "t array<string>")
    after = K.remove_stopwords(F.col("t"), stopwords("custom"))
    rows = df.select(after.alias("a"), K.removal_rate(F.col("t"), after).alias("r"),
                     K.removed_words(F.col("t"), after).alias("w")).collect()
    assert rows[0].a == ["cat", "not"] and abs(rows[0].r - 0.6) < 1e-12 and rows[0].w == ["is", "the"]
    assert rows[1].r == 0.0 and rows[1].w == []


PORTER = {"caresses": "caress", "ponies": "poni", "ties": "tie", "cats": "cat", "feed": "feed",
          "agreed": "agre", "plastered": "plaster", "motoring": "motor", "sing": "sing",
          "conflated": "conflat", "troubled": "troubl", "sized": "size", "hopping": "hop",
          "falling": "fall", "hissing": "hiss", "failing": "fail", "filing": "file",
          "happy": "happi", "sky": "sky", "relational": "relat", "conditional": "condit",
          "digitizer": "digit", "radicalli": "radic", "sensibiliti": "sensibl",
          "triplicate": "triplic", "formative": "form", "electrical": "electr",
          "goodness": "good", "revival": "reviv", "allowance": "allow", "replacement": "replac",
          "adoption": "adopt", "communism": "commun", "effective": "effect", "rate": "rate",
          "cease": "ceas", "controll": "control", "roll": "roll", "dying": "die", "y": "y",
          "misinformation": "misinform", "unprecedented": "unpreced"}
SNOWBALL = {"consign": "consign", "consigned": "consign", "consistency": "consist",
            "consolation": "consol", "knightly": "knight", "knock": "knock", "generously": "generous",
            "generate": "generat", "communication": "communic", "skies": "sky", "dying": "die",
            "early": "earli", "ties": "tie", "cries": "cri", "gas": "gas", "gaps": "gap",
            "hopping": "hop", "hoping": "hope", "luxuriated": "luxuri", "cry": "cri", "by": "by",
            "say": "say", "kiwis": "kiwi", "sensational": "sensat",
            "national": "nation", "geology": "geolog", "innings": "inning", "proceeding": "proceed",
            "youthful": "youth", "arsenic": "arsenic"}


def test_stemmers(spark):
    for stem, cases in ((porter, PORTER), (snowball, SNOWBALL)):
        df = spark.createDataFrame([(w,) for w in cases], "word string")
        got = {r.word: r.s for r in stem(df, "word", "s").collect()}
        assert got == cases


def test_over_stemming_of_domain_terms(spark):
    # Twenty domain terms.
    terms = ("misinformation disinformation verification fact-checking propaganda manipulation "
             "sensationalism exaggeration credibility authenticity misleading fabricated conspiracy "
             "allegations investigations politicians democratic governmental unprecedented "
             "controversial").split()
    df = spark.createDataFrame([(t,) for t in terms], "word string")
    rows = {r.method: (r.n_terms, r.over_stemmed) for r in N.over_stemming(df).collect()}
    assert rows["lemma"] == (20, 0) and rows["porter"] == (20, 2) and rows["snowball"][0] == 20


def test_normalize_keeps_order_and_unmapped(spark):
    docs = spark.createDataFrame([(1, ["b", "cats", "a", "cats"]), (2, [])], "doc_id long, tokens array<string>")
    mapping = spark.createDataFrame([("cats", "cat")], "word string, norm string")
    rows = {r.doc_id: r.tokens_normalized for r in N.normalize_via_vocab(docs, mapping).collect()}
    assert rows == {1: ["b", "cat", "a", "cat"], 2: []}


def test_lemma_prefers_noun(spark):
    words = spark.createDataFrame([("saw",), ("cities",)], "word string")
    dictionary = spark.createDataFrame([("saw", "see", "v"), ("saw", "saw", "n")], "word string, lemma string, pos string")
    assert {r.word: r.norm for r in N.lemma_vocab(words, dictionary).collect()} == {"saw": "saw", "cities": "city"}


def test_preprocess(spark):
    df = spark.createDataFrame([("The town's council printed BUDGET NEWS!!!",)], "text string")
    full = N.preprocess(df).first()
    assert full.processing_steps == list(N.STEPS) and full.token_count == len(full.tokens) > 0
    assert "'s" in full.tokens and full.tokens[-1] == "!"
    some = N.preprocess(df, ["remove_stopwords"]).first()
    assert some.tokens[-1] == "NEWS!!!" and some.removed_stopwords == ["the"]
    with pytest.raises(ValueError):
        N.preprocess(df, ["fly"])
