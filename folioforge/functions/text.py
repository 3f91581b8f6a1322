"""Text functions as column expressions: cleaning, normal forms, tokens, scripts, language and quality signals."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# White space beyond ASCII, and the words by which languages are told apart.
SPACE_LIKE = "\u00a0\u2007\u202f\u2060\ufeff"
WHITE = r"\t-\r\x1c-\x20\x85\xa0\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
LETTERS_AND_NUMERALS = r"[\p{L}\p{Nl}\p{No}]+"
STOPWORDS = {
    "es": """de la que el en y a los del se las por un para con no una su al lo como más pero sus le ya o este sí porque esta entre
        cuando muy sin sobre también me hasta hay donde quien desde todo nos durante todos uno les ni contra otros ese eso ante ellos e
        esto mí antes algunos qué unos yo otro otras otra él tanto esa estos mucho quienes nada muchos cual sea poco ella estar haber
        estas estaba estamos algunas algo nosotros""".split(),
    "en": """the of and to in a is that for it as was with be by on not he i this are or his from at which but have an they one you
        were all we there her she would their will been has when who more if no other so what its about into than them can only some
        could time these two may then do first any my now such like our over man me even most made after also did many before must
        through back years where much your way well down should because each just those people mr how too little state good very make
        world still own see men work long get here between both life being under never day same another know while last might us great
        old year off come since against go came right used take three""".split(),
    "pt": """de a o que e do da em um para com não uma os no se na por mais as dos como mas ao ele das à seu sua ou quando muito nos
        já eu também só pelo pela até isso ela entre depois sem mesmo aos seus quem nas me esse eles você essa num nem suas meu às
        minha numa pelos elas qual nós lhe deles essas esses pelas este dele tu te vocês vos lhes meus minhas teu tua""".split(),
}
DIACRITICS = {"es": "ñáéíóúü¿¡", "en": "", "pt": "ãõçáéíóúâêô"}
SCRIPT_RANGES = {
    "latin": r"\x{41}-\x{24F}\x{1E00}-\x{1EFF}",
    "greek": r"\x{370}-\x{3FF}\x{1F00}-\x{1FFF}",
    "cyrillic": r"\x{400}-\x{52F}",
    "hebrew": r"\x{590}-\x{5FF}",
    "arabic": r"\x{600}-\x{6FF}\x{750}-\x{77F}\x{FB50}-\x{FDFF}\x{FE70}-\x{FEFF}",
    "devanagari": r"\x{900}-\x{97F}",
    "thai": r"\x{E00}-\x{E7F}",
    "hangul": r"\x{1100}-\x{11FF}\x{3130}-\x{318F}\x{AC00}-\x{D7AF}",
    "kana": r"\x{3040}-\x{309F}\x{30A0}-\x{30FF}",
    "han": r"\x{4E00}-\x{9FFF}\x{3400}-\x{4DBF}\x{F900}-\x{FAFF}",
}
LANGUAGE_OF_SCRIPT = {"cyrillic": "ru", "arabic": "ar", "hangul": "ko", "kana": "ja", "han": "zh", "greek": "el", "hebrew": "he"}
FAMILIES = {"alphabetic": ("latin", "greek", "cyrillic"), "abjad": ("arabic", "hebrew"), "cjk": ("han", "kana", "hangul")}


def _accents() -> tuple[str, str]:
    """Letters whose canonical decomposition is one letter and marks, and that letter, by rule from the Unicode tables."""
    import unicodedata

    pairs = []
    for code in range(0xC0, 0x1F00):
        base = [c for c in unicodedata.normalize("NFD", chr(code)) if unicodedata.category(c) != "Mn"]
        if len(base) == 1 and base[0] != chr(code):
            pairs.append((chr(code), base[0]))
    return "".join(a for a, _ in pairs), "".join(b for _, b in pairs)


ACCENTED, PLAIN = _accents()


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """use(value), value being computed once however often it is used, inside lambdas too."""
    return F.element_at(F.transform(F.array(value), use), 1)


def count_chars(x: Column | str, of: str) -> Column:
    """How many characters of a class a text has: by the length it loses, as counting matches would build each of them."""
    return F.length(x) - F.length(F.regexp_replace(x, f"[{of}]+", ""))


def any_of(words: list[str]) -> str:
    """A pattern of some words that tries shared beginnings once. It matches the longest word that what follows allows."""
    import re

    tree: dict = {}
    for w in words:
        node = tree
        for c in w:
            node = node.setdefault(c, {})
        node[""] = {}

    def pattern(node: dict) -> str:
        ways = [re.escape(c) + pattern(rest) for c, rest in sorted(node.items()) if c]
        body = f"(?:{'|'.join(ways)})" if ways else ""
        return body + "?" if "" in node and ways else body

    return pattern(tree)


def strip(x: Column | str) -> Column:
    """White space off both ends, in Unicode's sense."""
    return F.regexp_replace(x, f"^[{WHITE}]+|[{WHITE}]+$", "")


def strip_nul(x: Column | str) -> tuple[Column, Column]:
    """The text without NUL characters, and how many there were."""
    bare = F.replace(x, F.lit("\x00"), F.lit(""))
    return bare, F.length(x) - F.length(bare)


def clean_text(x: Column | str, collapse_spaces: bool = False) -> Column:
    """Minimal cleaning: space-like characters to spaces, line separators, carriage returns and form feeds to line feeds, control and private
    characters dropped, runs of empty lines cut to one, ends stripped."""
    x = F.translate(F.replace(x, F.lit("\x00"), F.lit("")), SPACE_LIKE + "\u2028\u2029\r\f", " " * len(SPACE_LIKE) + "\n\n\n\n")
    x = F.regexp_replace(x, r"[\p{Cc}\p{Cf}\p{Co}\p{Cs}&&[^\n\t]]", "")
    if collapse_spaces:
        x = F.regexp_replace(x, "[ \t]{2,}", " ")
    return strip(F.regexp_replace(x, "\n{3,}", "\n\n"))


def normalize_value(x: Column | str) -> Column:
    """A cell's value: space-like characters to spaces, ends stripped."""
    return strip(F.translate(x, SPACE_LIKE, " " * len(SPACE_LIKE)))


def comparison_form(x: Column | str) -> Column:
    """Lower case without accents; all but a-z, 0-9 and spaces to single spaces; ends stripped. Other scripts vanish."""
    x = F.regexp_replace(F.translate(F.lower(x), ACCENTED, PLAIN), r"\p{Mn}", "")
    return F.trim(F.regexp_replace(F.regexp_replace(x, "[^a-z0-9 ]", " "), " +", " "))


def audit_form(x: Column | str) -> Column:
    """The text without control characters and white space, for counting."""
    return F.regexp_replace(x, rf"[\x00-\x1f{WHITE}]", "")


def token_count(x: Column | str) -> Column:
    """Words (letters, numerals, underscores) and single other characters that aren't white space."""
    return F.regexp_count(x, F.lit(rf"[\p{{L}}\p{{N}}_]+|[^\p{{L}}\p{{N}}_{WHITE}]"))


def word_tokens(x: Column | str, limit: int = 40_000) -> Column:
    """Lower-case runs of letters in the first limit characters."""
    return F.regexp_extract_all(F.lower(F.substring(x, 1, limit)), F.lit(LETTERS_AND_NUMERALS), F.lit(0))


def join_lines(x: Column | str) -> Column:
    """Lines joined by a space; a word cut by a hyphen at a line's end is made whole."""
    return strip(F.regexp_replace(F.regexp_replace(x, r"([\p{L}\p{N}_]{2,})-[ \t]*\n\s*", "$1"), r"\s*\n\s*", " "))


def script_counts(x: Column | str, limit: int = 200_000) -> Column:
    """Letters of each script, array<struct<script, n>>; scripts without letters are left out, letters of none count as `other`.

    Texts of Latin letters only, the usual case, cost two passes.
    """
    part = F.substring(x, 1, limit)
    letters = count_chars(part, r"\p{L}")
    of = {s: count_chars(part, rf"{r}&&\p{{L}}") for s, r in SCRIPT_RANGES.items()}
    entry = lambda s, n: F.struct(F.lit(s).alias("script"), n.cast("long").alias("n"))
    known = F.array(*(entry(s, n) for s, n in of.items()))
    rest = letters - sum(of.values(), F.lit(0))
    every = F.filter(F.concat(known, F.array(entry("other", rest))), lambda e: e["n"] > 0)
    return F.when(of["latin"] == letters, F.filter(F.array(entry("latin", letters)), lambda e: e["n"] > 0)).otherwise(every)


def _count_of(counts: Column, script: str) -> Column:
    return F.coalesce(F.try_element_at(F.transform(F.filter(counts, lambda e: e["script"] == script), lambda e: e["n"]), F.lit(1)), F.lit(0))


def dominant_script(counts: Column) -> Column:
    """Kana with a twentieth of the letters wins, else the commonest; null without letters. Ties go to the earlier range."""
    total = F.aggregate(counts, F.lit(0).cast("long"), lambda a, e: a + e["n"])
    top = F.array_max(F.transform(counts, lambda e: e["n"]))
    most = F.try_element_at(F.filter(counts, lambda e: e["n"] == top), F.lit(1))["script"]
    return F.when(F.size(counts) == 0, None).when(_count_of(counts, "kana") >= 0.05 * total, "kana").otherwise(most)


def script_family(script: Column) -> Column:
    out = F.when(script.isNull(), "unknown")
    for family, scripts in FAMILIES.items():
        out = out.when(script.isin(*scripts), family)
    return out.otherwise("other")


LETTER = r"[\p{L}\p{Nl}\p{No}]"


def stopword_ratio(x: Column, language: str) -> Column:
    """Share of stop words among the words of a lower-case text."""
    n = F.regexp_count(x, F.lit(LETTERS_AND_NUMERALS))
    stop = F.regexp_count(x, F.lit(f"(?<!{LETTER}){any_of(STOPWORDS[language])}(?!{LETTER})"))
    return F.when(n == 0, F.lit(0.0)).otherwise(stop / n)


def with_language(df: DataFrame, text: str = "text") -> DataFrame:
    """df with scripts, script, language and language_confidence."""
    df = df.withColumn("scripts", script_counts(text)).withColumn("script", dominant_script(F.col("scripts")))
    df = df.withColumn("__words", F.when(F.col("script") == "latin", F.lower(F.substring(text, 1, 40_000))))
    low = F.lower(F.substring(text, 1, 20_000))
    hint = {k: F.when(low.rlike(f"[{marks}]"), 0.02).otherwise(0.0) if marks else F.lit(0.0) for k, marks in DIACRITICS.items()}
    df = df.withColumns({f"__{k}": stopword_ratio(F.col("__words"), k) + hint[k] for k in STOPWORDS})
    scores = [F.col(f"__{k}") for k in STOPWORDS]
    best = F.greatest(*scores)
    second = F.element_at(F.sort_array(F.array(*scores)), 2)
    winner = F.lit(None)
    for k in reversed(STOPWORDS):
        winner = F.when(F.col(f"__{k}") == best, k).otherwise(winner)
    total = F.aggregate("scripts", F.lit(0).cast("long"), lambda a, e: a + e["n"])
    kana = _count_of(F.col("scripts"), "kana") >= 0.02 * total
    by_script = F.when((F.col("script") == "han") & kana, "ja")
    for s, k in LANGUAGE_OF_SCRIPT.items():
        by_script = by_script.when(F.col("script") == s, k)
    latin = (F.col("script") == "latin") & (F.regexp_count("__words", F.lit(LETTERS_AND_NUMERALS)) >= 15)
    sure = F.round(F.greatest(F.least(F.lit(1.0), best * 3) * (1 - F.least(F.lit(0.9), second / F.greatest(best, F.lit(1e-9)))), F.lit(0.1)), 3)
    df = df.withColumn("language", F.when(latin & (best >= 0.03), winner).when(F.col("script") != "latin", by_script))
    df = df.withColumn("language_confidence", F.when(latin, F.when(best >= 0.03, sure).otherwise(best)).when(by_script.isNotNull(), 0.9).otherwise(0.0))
    return df.drop("__words", *(f"__{k}" for k in STOPWORDS))


def printable_ratio(x: Column | str) -> Column:
    n = F.length(x)
    return F.when(n == 0, F.lit(0.0)).otherwise(1 - count_chars(x, r"\p{C}&&[^\n\t]") / n)


def alphabetic_ratio(x: Column | str) -> Column:
    n = F.length(x)
    return F.when(n == 0, F.lit(0.0)).otherwise(count_chars(x, r"\p{L}") / n)


def char_distribution(x: Column | str, limit: int = 50_000) -> Column:
    """How natural the frequencies of letters look, 0 to 1, by their entropy and the commonest letter's share; 0.5 for under 100 letters."""

    def of_letters(letters: Column) -> Column:
        n = F.length(letters)
        counts = let(n, lambda m: F.transform(F.array_distinct(F.split(letters, "")), lambda c: (m - F.length(F.replace(letters, c, F.lit("")))) / m))
        shares = F.when(n >= 100, F.filter(counts, lambda p: p > 0))
        return let(shares, lambda ps: let(F.aggregate(ps, F.lit(0.0), lambda a, p: a - p * F.log2(p)), lambda h: of_shares(ps, h)))

    def of_shares(shares: Column, entropy: Column) -> Column:
        base = F.when(entropy.between(3.2, 5.2), 1.0).when(entropy < 3.2, F.greatest(F.lit(0.0), entropy / 3.2)).otherwise(F.greatest(F.lit(0.0), 1 - (entropy - 5.2) / 3.0))
        return F.when(shares.isNull(), F.lit(0.5)).otherwise(F.round(base * F.when(F.array_max(shares).between(0.05, 0.30), 1.0).otherwise(0.6), 4))

    return let(F.lower(F.regexp_replace(F.substring(x, 1, limit), r"\P{L}+", "")), of_letters)


def known_word_ratio(x: Column | str, language: Column, script: Column) -> Column:
    """Share of stop words in the first 20,000 characters, or of letters in the script's range for scripts without spaces or vowels."""
    part = F.substring(x, 1, 20_000)
    letters = count_chars(part, r"\p{L}")
    share = lambda r: F.when(letters == 0, F.lit(0.0)).otherwise(F.round(count_chars(part, r) / letters, 4))
    family = script_family(script)
    by_language = F.lit(0.5)
    for k in STOPWORDS:
        by_language = F.when(language == k, F.round(stopword_ratio(F.lower(part), k), 4)).otherwise(by_language)
    words = F.when(language.isNull() | ~language.isin(*STOPWORDS) | (F.regexp_count(part, F.lit(LETTERS_AND_NUMERALS)) < 20), F.lit(0.5)).otherwise(by_language)
    return F.when(family == "cjk", share(r"\x{3040}-\x{9FFF}\x{AC00}-\x{D7AF}")).when(family == "abjad", share(r"\x{600}-\x{6FF}")).otherwise(words)


def repetition_ratio(x: Column | str) -> Column:
    """Share of repeated lines among those of over 15 characters; 0 for under five of them."""
    lines = F.filter(F.transform(F.split(x, "\n"), strip), lambda s: F.length(s) > 15)
    return let(lines, lambda ls: F.when(F.size(ls) < 5, F.lit(0.0)).otherwise(F.round(1 - F.size(F.array_distinct(ls)) / F.size(ls), 4)))


SIGNALS = ["characters", "printable_ratio", "alphabetic_ratio", "char_distribution", "known_word_ratio", "average_word_length", "single_char_token_ratio", "repetition_ratio", "nul_count"]


def with_signals(df: DataFrame, text: str = "text") -> DataFrame:
    """df(text, language, script) with the quality signals as columns."""
    part = F.substring(text, 1, 20_000)
    count = lambda p: F.regexp_count(part, F.lit(p))
    n, letters, single = count(LETTERS_AND_NUMERALS), count_chars(part, r"\p{L}\p{Nl}\p{No}"), count(f"(?<!{LETTER}){LETTER}(?!{LETTER})")
    return df.withColumns(
        {
            "characters": F.length(text).cast("double"),
            "printable_ratio": F.round(printable_ratio(text), 4),
            "alphabetic_ratio": F.round(alphabetic_ratio(text), 4),
            "char_distribution": char_distribution(text),
            "known_word_ratio": known_word_ratio(text, F.col("language"), F.col("script")),
            "average_word_length": F.when(n == 0, F.lit(0.0)).otherwise(F.round(letters / n, 3)),
            "single_char_token_ratio": F.when(n == 0, F.lit(0.0)).otherwise(F.round(single / n, 4)),
            "repetition_ratio": repetition_ratio(text),
            "nul_count": strip_nul(F.col(text))[1].cast("double"),
        }
    )


def _distinct_words(x: Column) -> Column:
    return F.array_distinct(F.filter(F.split(x, " "), lambda w: w != ""))


def token_overlap(needle: Column, haystack: Column) -> Column:
    """Distinct words of needle that haystack has, over its distinct words; 0 for an empty needle. Both in comparison form."""
    return let(_distinct_words(needle), lambda a: F.when(F.size(a) == 0, F.lit(0.0)).otherwise(F.size(F.array_intersect(a, _distinct_words(haystack))) / F.size(a)))


def jaccard(a: Column, b: Column) -> Column:
    """Shared distinct words over all distinct words; 0 for two empty texts. Both in comparison form."""

    def of(x: Column, y: Column) -> Column:
        both = F.size(F.array_intersect(x, y))
        return F.coalesce(F.try_divide(both, F.size(x) + F.size(y) - both), F.lit(0.0))

    return let(_distinct_words(a), lambda x: let(_distinct_words(b), lambda y: of(x, y)))
