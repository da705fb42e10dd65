"""Text expressions: Column in, Column out, all of them inside whole-stage code."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

WILD = "<*>"

# Variable patterns, in the order in which they apply.
VARIABLE_PATTERNS = (
    r"\b\d{4}-\d{2}-\d{2}[T\s]\d{2}:\d{2}:\d{2}(?:\.\d+)?(?:Z|[+-]\d{2}:?\d{2})?\b",
    r"\b0[xX][a-fA-F0-9]+\b",
    r"\b[a-fA-F0-9]{8}-[a-fA-F0-9]{4}-[a-fA-F0-9]{4}-[a-fA-F0-9]{4}-[a-fA-F0-9]{12}\b",
    r"\b(?:\d{1,3}\.){3}\d{1,3}\b",
    r"\b\d+(?:\.\d+)?\b",
)
# Masks of known datasets; any other dataset has the variable patterns.
DATASET_MASKS = {
    "HDFS": (r"blk_-?\d+", r"(\d+\.){3}\d+(:\d+)?"),
    "Hadoop": (r"(\d+\.){3}\d+",),
    "Spark": (r"(\d+\.){3}\d+", r"\b[KGTM]?B\b", r"([\w-]+\.){2,}[\w-]+"),
    "Zookeeper": (r"(/|)(\d+\.){3}\d+(:\d+)?",),
    "BGL": (r"core\.\d+",),
    "HPC": (r"=\d+",),
    "Thunderbird": (r"(\d+\.){3}\d+",),
    "Windows": (r"0x.*?\s",),
    "Linux": (r"(\d+\.){3}\d+", r"\d{2}:\d{2}:\d{2}"),
    "Android": (r"(/[\w-]+)+", r"([\w-]+\.){2,}[\w-]+", r"\b(\-?\+?\d+)\b|\b0[Xx][a-fA-F\d]+\b|\b[a-fA-F\d]{4,}\b"),
    "HealthApp": (),
    "Apache": (r"(\d+\.){3}\d+",),
    "Proxifier": (r"<\d+\ssec", r"([\w-]+\.)+[\w-]+(:\d+)?", r"\d{2}:\d{2}(:\d{2})*", r"[KGTM]B"),
    "OpenSSH": (r"(\d+\.){3}\d+", r"([\w-]+\.){2,}[\w-]+"),
    "OpenStack": (r"((\d+\.){3}\d+,?)+", r"/.+?\s", r"\d+"),
    "Mac": (r"([\w-]+\.){2,}[\w-]+",),
}
# Tree settings (similarity, depth) of known datasets.
DATASET_TREES = {
    "HDFS": (0.5, 4), "Hadoop": (0.5, 4), "Spark": (0.5, 4), "Zookeeper": (0.5, 4), "BGL": (0.5, 4), "HPC": (0.5, 4), "Thunderbird": (0.5, 4),
    "Windows": (0.7, 5), "Linux": (0.39, 6), "Android": (0.2, 6), "HealthApp": (0.2, 4), "Apache": (0.5, 4), "Proxifier": (0.6, 3),
    "OpenSSH": (0.6, 5), "OpenStack": (0.5, 5), "Mac": (0.7, 6), "default": (0.2, 4),
}
# How an answer begins that is talk and no template.
PREAMBLES = (
    "it seems", "it looks like", "i understand", "i can help", "i'll ", "i will ", "let me", "sure,", "sure!", "sure.", "here is", "here's", "based on",
    "to parse", "i notice", "i see", "please provide", "please clarify", "could you", "i'm not sure", "unfortunately", "certainly", "of course",
)

LEVELS = ("raw", "spaced", "lowercase", "regex_clean")


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip(c: Column | str) -> Column:
    """Without white space of any kind at either end."""
    return F.regexp_replace(col(c), r"(?U)^\s+|\s+$", "")


def squeeze(c: Column | str) -> Column:
    """Runs of white space as one space, none at the ends."""
    return strip(F.regexp_replace(col(c), r"(?U)\s+", " "))


def space_tokens(c: Column | str) -> Column:
    """Tokens between single spaces; two spaces in a row have an empty token between them."""
    return F.split(col(c), " ", -1)


def word_tokens(c: Column | str) -> Column:
    """Tokens between runs of white space, none empty."""
    return F.filter(F.split(col(c), r"(?U)\s+", -1), lambda t: t != "")


def fold(c: Column, patterns: tuple[str, ...], to: str = WILD) -> Column:
    for p in patterns:
        c = F.regexp_replace(c, p, to)
    return c


def premask(c: Column | str) -> Column:
    """Obvious variables as wildcards, neighbours among them as one."""
    return strip(F.regexp_replace(fold(col(c), VARIABLE_PATTERNS), r"<\*>\s*(?:<\*>\s*)+", "<*> "))


def dataset_mask(message: Column | str, dataset: Column | str) -> Column:
    """A known dataset's masks alone, else the variable patterns."""
    m, d = col(message), col(dataset)
    out = F.when(F.lit(False), m)
    for name, patterns in DATASET_MASKS.items():
        out = out.when(d == name, fold(m, patterns))
    return out.otherwise(fold(m, VARIABLE_PATTERNS))


def untag(c: Column | str) -> Column:
    """Tagged variables as plain wildcards."""
    return F.regexp_replace(col(c), r"<(?!\*+>)[^>]+>", WILD)


def untag_upper(c: Column | str) -> Column:
    """Upper-case tags as plain wildcards."""
    return strip(F.regexp_replace(col(c), r"<[A-Z_]+>", WILD))


def at_level(c: Column | str, level: str) -> Column:
    """A text as a level of sensitivity compares it."""
    if level == "raw":
        return col(c)
    text = squeeze(c)
    if level == "spaced":
        return text
    if level == "lowercase":
        return F.lower(text)
    if level == "regex_clean":
        return F.lower(F.regexp_replace(text, r"[.\s,:;()\[\]{}|]+$", ""))
    raise ValueError(f"no such level: {level}")


_REGEX_SPECIALS = ("[", "]", "(", ")", "{", "}", "+", "*", "?", ".", "^", "$", "|", "-", "\\")


def regex_to_template(c: Column | str) -> Column:
    """A regex with lazy captures as a template; null as an empty text."""
    out = F.regexp_replace(F.replace(F.coalesce(col(c), F.lit("")), F.lit("(.*?)"), F.lit(WILD)), r"\$\z", "")
    for s in _REGEX_SPECIALS:
        out = F.replace(out, F.lit("\\" + s), F.lit(s))
    return out


def escape_regex(c: Column | str) -> Column:
    """The text with every regex metacharacter escaped."""
    return F.regexp_replace(col(c), r"([\\^$.|?*+()\[\]{}\-#&~])", r"\\$1")


def template_to_regex(c: Column | str) -> Column:
    """An anchored regex with a lazy capture for each wildcard; runs of wildcards with little between them are one.

    That keeps a template of dozens of list items from becoming a pattern that backtracks for ever.
    """
    one = F.regexp_replace(col(c), r"<\*>\s*(?:<\*>\s*)+", "<*> ")
    one = strip(F.regexp_replace(one, r"<\*>(?:\s*[^\w\s<]{1,3}\s*<\*>)+", WILD))
    return F.concat(F.lit("^"), F.replace(escape_regex(one), F.lit(r"<\*>"), F.lit("(.*?)")), F.lit("$"))


def jaccard(a: Column, b: Column, empty: float = 1.0) -> Column:
    """Of two token arrays as sets; `empty` where both are empty."""
    union = F.size(F.array_union(a, b))
    return F.when(union == 0, F.lit(empty)).otherwise(F.size(F.array_intersect(a, b)) / union)


def _pairs(a: Column, b: Column) -> Column:
    n = F.least(F.size(a), F.size(b))
    return F.arrays_zip(F.slice(a, 1, n).alias("a"), F.slice(b, 1, n).alias("b"))


def positional_uniform(a: Column, b: Column) -> Column:
    """The share of equal tokens at equal places of the shorter length; 0 if that is 0."""
    n = F.least(F.size(a), F.size(b))
    same = F.zip_with(F.slice(a, 1, n), F.slice(b, 1, n), lambda x, y: (x == y).cast("int"))
    return F.when(n == 0, 0.0).otherwise(F.aggregate(same, F.lit(0), lambda s, x: s + x) / n)


def positional_decay(a: Column, b: Column, decay: float = 0.15) -> Column:
    """As positional_uniform, with a weight of exp(-decay * place)."""
    n = F.least(F.size(a), F.size(b))
    same = F.zip_with(F.slice(a, 1, n), F.slice(b, 1, n), lambda x, y: (x == y).cast("double"))
    weights = F.transform(F.sequence(F.lit(0), F.greatest(n - 1, F.lit(0))), lambda i: F.exp(i * -decay))
    total = F.aggregate(weights, F.lit(0.0), lambda s, x: s + x)
    got = F.aggregate(F.zip_with(same, weights, lambda x, w: F.coalesce(x, F.lit(0.0)) * w), F.lit(0.0), lambda s, x: s + x)
    return F.when(n == 0, 0.0).otherwise(got / total)


def is_variable(t: Column) -> Column:
    return t.rlike(r"^<.*>$")


def structural(a: Column, b: Column) -> Column:
    """The share of places where both tokens are equal or both are variables; 0 for different lengths or none."""
    same = F.zip_with(a, b, lambda x, y: ((x == y) | (is_variable(x) & is_variable(y))).cast("int"))
    return F.when((F.size(a) != F.size(b)) | (F.size(a) == 0), 0.0).otherwise(F.aggregate(same, F.lit(0), lambda s, x: s + x) / F.size(a))


def sequence_distance(template: Column, tokens: Column) -> Column:
    """struct<similarity, wildcards>: equal tokens where the template is fixed, by length; and its number of wildcards."""
    same = F.zip_with(template, tokens, lambda x, y: ((x != WILD) & (x == y)).cast("int"))
    return F.struct((F.aggregate(same, F.lit(0), lambda s, x: s + x) / F.size(template)).alias("similarity"), F.size(F.filter(template, lambda x: x == WILD)).alias("wildcards"))


def merge_tokens(a: Column, b: Column) -> Column:
    """Two token arrays of one length as one, with wildcards where they differ."""
    return F.zip_with(a, b, lambda x, y: F.when(x == y, x).otherwise(F.lit(WILD)))


def edit_similarity(a: Column, b: Column) -> Column:
    """1 - edit distance / the longer length; 1 for two empty texts."""
    longest = F.greatest(F.length(a), F.length(b))
    return F.when(longest == 0, 1.0).otherwise(1 - F.levenshtein(a, b) / longest)


def standardized(c: Column | str) -> Column:
    """What is left of a text without path parts, digits, separators and white space."""
    return fold(col(c), (r"/([^/]*)(?=/)", r"\d", r"[/:,._-]+", r"(?U)\s"), "")


def standard_hash(c: Column | str) -> Column:
    return F.sha2(standardized(c), 256)


def event_id(template: Column | str) -> Column:
    return F.substring(F.md5(col(template)), 1, 8)


def noise_key(message: Column | str) -> Column:
    """What noise logs are grouped by: their words without values, numbers, paths and brackets."""
    m = col(message)
    words = F.split(m, r"[ ,|]", -1)
    keep = F.transform(
        words,
        lambda w: F.when(F.instr(w, "=") > 0, F.when(F.size(F.split(w, "=", -1)) <= 2, F.substring_index(w, "=", 1)).otherwise(F.lit("")))
        .when(w.rlike(r"\d"), F.lit(""))
        .when((F.instr(w, "/") > 0) | w.rlike(r"^[a-zA-Z][+-]$|^[+-][a-zA-Z]$"), F.lit(""))
        .otherwise(F.regexp_replace(w, r"\([^)]*\)", "")),
    )
    keep = F.filter(keep, lambda w: w != "")
    return F.when(F.size(keep) == 0, F.regexp_replace(m, r"\d+(\.\d+)?", "0")).otherwise(F.array_join(keep, " "))


def is_template(c: Column | str) -> Column:
    """Whether an answer looks like a template: not empty, no placeholder of another kind, no echo of the question, no talk."""
    t = col(c)
    talk = F.lit(False)
    low = F.lower(strip(t))
    for p in PREAMBLES:
        talk = talk | low.startswith(p)
    odd = t.contains("{{") | t.contains("}}") | t.contains('"template"') | t.contains("'template'")
    return F.coalesce((F.length(t) > 0) & ~odd & ~talk, F.lit(False))


_PUNCTUATION = r"!-/:-@\[-`{-~"


def says_something(template: Column | str) -> Column:
    """Whether anything but wildcards, spaces and punctuation is in the template."""
    return F.replace(F.replace(col(template), F.lit(WILD), F.lit("")), F.lit(" "), F.lit("")).rlike(f"[^{_PUNCTUATION}]")


def is_thin(c: Column | str) -> Column:
    """Fewer than three characters that are neither punctuation nor spaces."""
    return F.length(F.regexp_replace(col(c), f"[{_PUNCTUATION} ]", "")) < 3


def is_constant(message: Column | str) -> Column:
    """A message that holds nothing which could vary, if it is the only one of its group."""
    m = col(message)
    parts = (" is ", "=", " to ", "_", "-", ":", ".")
    out = ~m.rlike(r"(?U)\d")
    for p in parts:
        out = out & ~m.contains(p)
    return out


def is_long_failure(message: Column | str) -> Column:
    """More than 100 words of the one known kind of endless message."""
    return (F.size(word_tokens(message)) > 100) & col(message).rlike("Warning: we failed to resolve data source name (.*?)$")


def is_digit_heavy(token: Column | str) -> Column:
    """A token that digits dominate: no letter first, no upper case, and four digits or more, or over 30 % of it."""
    t = col(token)
    digits = F.length(t) - F.length(F.regexp_replace(t, r"(?U)\d", ""))
    return (digits > 0) & ~t.rlike(r"^\p{L}") & ~t.rlike(r"\p{Lu}") & ((digits >= 4) | (digits / F.length(t) > 0.3))


def without_digits(message: Column | str) -> Column:
    return F.regexp_replace(col(message), r"(?U)\d+", "")


def unfence(c: Column | str) -> Column:
    """An answer without a fence of backticks around it and without backticks; null as an empty text."""
    t = strip(F.coalesce(col(c), F.lit("")))
    body = F.when(F.instr(t, "\n") > 0, F.substring(t, F.instr(t, "\n") + 1, F.length(t))).otherwise(t)
    body = F.when(body.endswith("```") & (F.instr(body, "\n") > 0), F.regexp_replace(body, r"\n[^\n]*\z", "")).otherwise(body)
    return strip(F.replace(F.when(t.startswith("```"), body).otherwise(t), F.lit("`"), F.lit("")))


def clip_words(c: Column | str, most: int, tail: str = "") -> Column:
    """At most so many characters, cut back to the end of a word, with `tail` after a cut."""
    t = col(c)
    head = F.substring(t, 1, most)
    cut = F.when(F.instr(head, " ") > 0, F.regexp_replace(head, r" [^ ]*\z", "")).otherwise(head)
    return F.when(F.length(t) <= most, t).otherwise(F.concat(cut, F.lit(tail)))


def clip(c: Column | str, most: int, tail: str = "...") -> Column:
    t = col(c)
    return F.when(F.length(t) <= most, t).otherwise(F.concat(F.substring(t, 1, most), F.lit(tail)))


def duration(seconds: Column | str) -> Column:
    """Hours, minutes and seconds, those that count; 0s for null and negative values."""
    s = col(seconds)
    h, m, r = F.floor(s / 3600), F.floor((s % 3600) / 60), F.format_string("%.1fs", (s % 60).cast("double"))
    return F.when(s.isNull() | (s < 0), F.lit("0s")).when(h > 0, F.concat(h.cast("string"), F.lit("h "), m.cast("string"), F.lit("m "), r)).when(m > 0, F.concat(m.cast("string"), F.lit("m "), r)).otherwise(r)


def rate(part: Column, whole: Column) -> Column:
    """part / whole; 0 where there is no whole."""
    return F.coalesce(F.try_divide(part.cast("double"), whole.cast("double")), F.lit(0.0))


# What each tag means in a record, by category set.
CATEGORIES = {
    "ecs_10": {"<TDA>": "event.ingested", "<LOI>": "source.ip", "<OID>": "file.path", "<USR>": "user.name", "<POR>": "source.port", "<STA>": "event.outcome", "<VER>": "service.version", "<PRO>": "network.transport", "<NUM>": "event.duration", "<COM>": "process.name"},
    "paper_10": {"<OID>": "file.path", "<LOI>": "source.ip", "<OBN>": "process.name", "<TID>": "event.type", "<SID>": "event.action", "<TDA>": "event.ingested", "<CRS>": "host.cpu", "<OBA>": "event.duration", "<STC>": "event.outcome", "<OTP>": "otp_value"},
    "ecs_3": {"<LOI>": "source.ip", "<OID>": "file.path", "<TDA>": "event.ingested"},
}


def category_field(tag: Column | str, categories: str = "ecs_3") -> Column:
    """The record field of a tag; null for tags outside the set. `10` and `3` are short for the ecs sets."""
    known = CATEGORIES[{"10": "ecs_10", "3": "ecs_3"}.get(str(categories), str(categories))]
    return F.element_at(F.create_map(*(F.lit(x) for kv in known.items() for x in kv)), col(tag))


def tags_of(template: Column | str) -> Column:
    return F.regexp_extract_all(col(template), F.lit("<[A-Z]{3}>"), F.lit(0))


# What each tag matches in an ingest pipeline.
GROK = {
    "<LOI>": "%{IP:source.ip}", "<TDA>": "%{TIMESTAMP_ISO8601:timestamp}", "<OID>": "%{NOTSPACE:file.path}", "<OBN>": "%{NOTSPACE:process.name}",
    "<TID>": "%{NOTSPACE:event.type}", "<SID>": "%{NOTSPACE:event.action}", "<CRS>": "%{NOTSPACE:host.cpu}", "<OBA>": "%{NUMBER:event.duration}",
    "<STC>": "%{NOTSPACE:event.outcome}", "<OTP>": "%{GREEDYDATA:otp_value}", "<USR>": "%{NOTSPACE:user.name}", "<POR>": "%{NUMBER:source.port}",
    "<STA>": "%{NOTSPACE:event.outcome}", "<VER>": "%{NOTSPACE:service.version}", "<PRO>": "%{WORD:network.transport}", "<NUM>": "%{NUMBER:event.duration}",
    "<COM>": "%{NOTSPACE:process.name}", "<*>": "%{GREEDYDATA:custom_field}",
}


def grok_pattern(template: Column | str) -> Column:
    """The template as an ingest pattern: literal text escaped, tags as what they match.

    Angle brackets are no metacharacters, so escaping leaves three-letter tags as they are; only the bare wildcard changes its look.
    """
    escaped = F.regexp_replace(col(template), r"([\\^$.|?*+()\[\]{}#&~])", r"\\$1")
    for tag, grok in GROK.items():
        escaped = F.replace(escaped, F.lit(tag.replace("*", "\\*")), F.lit(grok))
    return escaped
