"""Fixed regular expressions.

Values the results depend on.  Word, digit and space classes are written out,
because the short forms mean different characters in different regex engines.
"""

# Fixed character classes.
WORD = r"[\p{L}\p{N}_]"
DIGIT = r"\p{Nd}"
# Unicode white space and the four separators U+001C to U+001F.  Patterns that
# use these classes start with the flag UNICODE, which widens \s; spelling the
# ranges out instead makes the matcher ten times slower.
UNICODE = "(?U)"
SPACE = r"[\s\x1C-\x1F]"
NONSPACE = r"[^\s\x1C-\x1F]"

# Fixed cleaning patterns.
HTML_TAG = r"<[^>]+>"
URL = rf"{UNICODE}https?://{NONSPACE}+|www\.{NONSPACE}+|ftp://{NONSPACE}+"
WEB_URL = rf"{UNICODE}https?://{NONSPACE}+|www\.{NONSPACE}+"
# Anchored at the start of a run of non-space characters: the same matches as
# without the anchor, but linear on very long runs.
EMAIL = rf"{UNICODE}(?<!{NONSPACE}){NONSPACE}+@{NONSPACE}+\.{NONSPACE}+"
MENTION = rf"@{WORD}+"
HASHTAG = rf"#{WORD}+"
HANDLE = rf"[@#]{WORD}+"
# The look-ahead skips ordinary characters early; it excludes no match.
EMOJI = (r"(?=[^\x00-\x{200C}])[\x{1F600}-\x{1F64F}\x{24C2}-\x{1F251}\x{10000}-\x{10FFFF}"
         r"\x{2640}-\x{2642}\x{2600}-\x{2B55}\x{200D}\x{23CF}\x{23E9}"
         r"\x{231A}\x{FE0F}\x{3030}]+")
EMOJI_STRICT = (r"[\x{1F600}-\x{1F64F}\x{1F300}-\x{1F5FF}\x{1F680}-\x{1F6FF}"
                r"\x{1F1E0}-\x{1F1FF}\x{2702}-\x{27B0}\x{1F926}-\x{1F937}"
                r"\x{2640}-\x{2642}\x{2600}-\x{2B55}\x{200D}\x{23CF}\x{23E9}"
                r"\x{231A}\x{FE0F}\x{3030}]+")
REPEATED_PUNCT = r"([!?.])\1+"
DASHES = r"-{2,}"
LONG_NUMBER = rf"(?<!{WORD}){DIGIT}{{4,}}(?!{WORD})"
MONEY = rf"\$[\p{{Nd}},.]+"
PERCENT = rf"(?<!{DIGIT}){DIGIT}+%"
SPECIAL = rf"""{UNICODE}[^\p{{L}}\p{{N}}_\s\x1C-\x1F.,!?;:'"-]"""

# Fixed tokenizer patterns.
VECTORIZER_TOKEN = rf"{WORD}{{2,}}"
TEXT_TOKEN = (rf"(?:[A-Za-z]\.)++|{WORD}++(?:[-']{WORD}++)*+"
              r"""|[.,!?;:"'()\[\]{}\-]""")
ASCII_WORD = r"^[a-zA-Z]+$"
