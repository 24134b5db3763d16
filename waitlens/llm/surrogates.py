"""Personal data replaced by keyed surrogates, in DataFrame expressions only.

Mail addresses, phone, card, account and social security numbers, network addresses,
credentials and titled names are found by pattern. Once a titled name is found in a text,
its parts are looked up among the capitalised words of that text, so later mentions without
a title read like the first; names that never stand behind a title are not found. Each is reduced to atoms (a kind and a
normalised value), and every distinct atom of the corpus gets one surrogate from a keyed
hash: digits stay digits, letters keep case and script, a card number keeps its check digit
right, a name keeps gender and script. So the same value reads the same everywhere, however
it is written. Surrogates that would coincide with one another or with a real value are
drawn again, which keeps different values different. A shape may have too few values for
that: after a few rounds its surrogates get longer, by one character more each round, and a
value without letters and digits, which no draw can change, is lengthened from the start.
So there is always room, and every value gets its surrogate.

Only texts with an entity are taken apart; the others pass through where they are read.
Patterns repeat single characters without bound, groups only a few times: matching a text
of any length needs no deep stack.

Results: null text stays null; repeated rows are replaced alike; an empty table gives no
rows; all other columns are carried through whatever their names; texts of any length are
read whole.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from waitlens.functions.identifiers import hmac_sha256
from waitlens.llm.common import Scratch
from waitlens.llm.patterns import gaps, matches

_NAME = r"\p{Lu}[\p{L}'’-]+"
MALE = ("Mr", "Mister", "Herr", "Monsieur", "Señor", "Sr", "господин")
FEMALE = ("Mrs", "Ms", "Miss", "Frau", "Madame", "Mme", "Mlle", "Señora", "Sra", "Srta", "госпожа")
_TITLE = "(?:" + "|".join((*MALE, *FEMALE, "Dr", "Prof")) + r")\.? "

# A run of characters is entered at its first one only, so a long run is read once.
PATTERNS = {
    # A host name has at most 127 labels.
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++){1,126}",
    "secret": r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*+[:=]\x20*+["']?[A-Za-z0-9+/_.=-]{6,}""",
    "access": r"AKIA[A-Z0-9]{16,}",
    "account": r"(?<![A-Za-z0-9])[A-Z]{2}\d{2}(?:\x20?[A-Z0-9]{4}){3,7}(?![A-Za-z0-9])",
    "phone": r"(?<![\w+])\+\d{1,3}[ .-]?\(?\d{2,4}\)?(?:[ .-]?\d{2,4}){1,4}(?!\d)"
    r"|(?<!\d)\(\d{3}\)\x20?\d{3}[ .-]\d{4}(?!\d)|(?<![\d.-])\d{3}[ .-]\d{3}[ .-]\d{4}(?![\d-])",
    "social": r"(?<![\d-])\d{3}-\d{2}-\d{4}(?![\d-])",
    # In one run, in fours, or as four, six and five digits.
    "card": r"(?<![\d.-])(?:\d{13,19}|\d{4}(?: \d{4}){2} \d{1,4}(?: \d{1,3})?|\d{4}(?:-\d{4}){2}-\d{1,4}(?:-\d{1,3})?"
    r"|\d{4} \d{6} \d{5}|\d{4}-\d{6}-\d{5})(?!\d)",
    "address": r"(?<![\d.])(?:\d{1,3}\.){3}\d{1,3}(?![\d]|\.\d)",
    "person": rf"(?<!\p{{L}}){_TITLE}{_NAME}(?: {_NAME})?",
}
#: A capitalised word, which may be a later mention of a name.
WORD = rf"(?<!\p{{L}}){_NAME}"
ANY = "|".join(f"(?:{p})" for p in PATTERNS.values())
#: What stands before the replaced part of a match.
PREFIX = {
    "secret": r"""^(?i:password|passwd|secret|token|api_?key)["']?\x20*+[:=]\x20*+["']?""",
    "person": f"^{_TITLE}",
}
SYLLABLES = {
    "latin": ("ba", "de", "ki", "lo", "mu", "na", "pe", "ri", "so", "tu", "va", "we", "zi", "fo", "ga", "he"),
    "cyrillic": ("ба", "де", "ки", "ло", "му", "на", "пе", "ри", "со", "ту", "ва", "ве", "зи", "фо", "га", "ле"),
    "greek": ("βα", "δε", "κι", "λο", "μυ", "να", "πε", "ρι", "σο", "τα", "φα", "χε", "ζι", "θο", "γα", "λε"),
}
ENDINGS = {"male": ("n", "н", "ς"), "female": ("a", "а", "α"), "any": ("s", "с", "ν")}
#: Rounds of drawing again in the same shape; after them surrogates grow.
SAME_LENGTH = 8
DIGITS, LOWER, UPPER = "0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def may_hold_some(text: Column) -> Column:
    """False only where no pattern can match: plain substring tests, far cheaper than those."""
    lowered = F.lower(text)
    test = text.rlike("[0-9]") | text.contains("@") | text.contains("AKIA")
    for word in ("password", "passwd", "secret", "token", "api_key", "apikey"):
        test = test | lowered.contains(word)
    for title in (*MALE, *FEMALE, "Dr", "Prof"):
        test = test | text.contains(title)
    return test


def kind_of(match: Column) -> Column:
    """The first kind whose pattern spells the whole match."""
    found = F.lit(None).cast("string")
    for kind, pattern in reversed(list(PATTERNS.items())):
        # The match stands alone here, so what looks around it is satisfied.
        found = F.when(match.rlike(f"^(?:{pattern})$"), kind).otherwise(found)
    return F.coalesce(found, F.lit("person"))


def _byte(digest: Column, i: Column) -> Column:
    """Byte ``i`` of a hash in hex; further round it, shifted by how often it went round."""
    at = (F.pmod(i, F.lit(32)) * 2 + 1).cast("int")
    return F.conv(F.substring(digest, at, F.lit(2)), 16, 10).cast("int") + F.floor(i / 32).cast("int") * 7


def _pick(choices: str, n: Column) -> Column:
    return F.substring(F.lit(choices), (F.pmod(n, F.lit(len(choices))) + 1).cast("int"), F.lit(1))


def same_shape(value: Column, digest: Column) -> Column:
    """Every digit and letter replaced by one of its own class, case and script."""
    upper_lower = (
        ("[0-9]", DIGITS),
        ("[a-z]", LOWER),
        ("[A-Z]", UPPER),
        (r"[\p{Ll}&&\p{IsCyrillic}]", "абвгдежзиклмнопрстуфхцчшэюя"),
        (r"[\p{Lu}&&\p{IsCyrillic}]", "АБВГДЕЖЗИКЛМНОПРСТУФХЦЧШЭЮЯ"),
        (r"[\p{Ll}&&\p{IsGreek}]", "αβγδεζηθικλμνξοπρστυφχψω"),
        (r"[\p{Lu}&&\p{IsGreek}]", "ΑΒΓΔΕΖΗΘΙΚΛΜΝΞΟΠΡΣΤΥΦΧΨΩ"),
        (r"\p{Ll}", LOWER),
        (r"\p{Lu}", UPPER),
    )

    def swap(char: Column, i: Column) -> Column:
        out = char
        for pattern, choices in reversed(upper_lower):
            out = F.when(char.rlike(pattern), _pick(choices, _byte(digest, i))).otherwise(out)
        return out

    return F.array_join(F.transform(F.split(value, ""), swap), "")


def check_sum(digits: Column) -> Column:
    """Sum of a card number's digits, every second one from the right doubled."""
    n = F.length(digits)

    def worth(char: Column, i: Column) -> Column:
        d = char.cast("int") * F.when((n - 1 - i) % 2 == 1, 2).otherwise(1)
        return F.when(d > 9, d - 9).otherwise(d)

    return F.aggregate(F.transform(F.split(digits, ""), worth), F.lit(0), lambda a, b: a + b)


def _spelled(choices: Column, n: int, digest: Column):
    return lambda i: F.element_at(choices, F.pmod(_byte(digest, i), F.lit(n)) + 1)


def name_like(digest: Column, gender: Column, script: Column, attempt: Column) -> Column:
    """An invented name: syllables of the script and an ending of the gender.

    A name drawn again is a syllable longer, so there are always enough.
    """
    out = F.lit("")
    for row, (alphabet, parts) in enumerate(SYLLABLES.items()):
        choices = F.array(*map(F.lit, parts))
        body = F.array_join(F.transform(F.sequence(F.lit(0), 2 + attempt), _spelled(choices, len(parts), digest)), "")
        ending = F.when(gender == "male", ENDINGS["male"][row]).when(gender == "female", ENDINGS["female"][row]).otherwise(ENDINGS["any"][row])
        out = F.when(script == alphabet, F.initcap(F.concat(body, ending))).otherwise(out)
    return out


def growth(norm: Column, attempt: Column) -> Column:
    """By how many characters a surrogate is longer than its value."""
    return F.when(norm.rlike(r"[0-9\p{L}]"), F.greatest(attempt - SAME_LENGTH, F.lit(0))).otherwise(attempt + 1)


def surrogate(key: bytes) -> Column:
    """From the columns kind, norm, gender, script and attempt."""
    digest = F.col("_digest")
    norm, kind, attempt = F.col("norm"), F.col("kind"), F.col("attempt")
    shaped = same_shape(norm, digest)
    longer = growth(norm, attempt)

    def more(spell, joint: str = "") -> Column:
        """As many further parts as the surrogate grows by."""
        parts = F.transform(F.sequence(F.lit(0), longer - 1), lambda i: F.concat(F.lit(joint), spell(F.length(norm) + i)))
        return F.when(longer > 0, F.array_join(parts, "")).otherwise("")

    drawn = lambda choices: lambda i: _pick(choices, _byte(digest, i))
    digits, lower, upper = more(drawn(DIGITS)), more(drawn(LOWER)), more(drawn(UPPER))
    local = F.substring_index(shaped, "@", 1)
    host = F.substring_index(F.substring_index(shaped, "@", -1), ".", 1)
    octet = lambda i: (F.pmod(_byte(digest, i), F.lit(254)) + 1).cast("string")
    body = F.concat(F.substring(norm, 1, 1), F.expr("substring(_shaped, 2, length(_shaped) - 2)"), digits)
    last = F.pmod(F.lit(10) - check_sum(F.concat(body, F.lit("0"))) % 10, F.lit(10)).cast("string")
    right = check_sum(norm) % 10 == 0
    card = F.concat(body, F.when(right, last).otherwise(F.substring(F.col("_shaped"), -1, 1)))
    return (
        F.when(kind == "email", F.concat(local, lower, F.lit("@"), host, F.lit(".example."), F.substring_index(norm, ".", -1)))
        .when(kind == "address", F.concat(F.concat_ws(".", *[octet(F.lit(i)) for i in range(4)]), more(octet, ".")))
        .when(kind == "card", card)
        .when(kind.isin("given", "family"), name_like(digest, F.col("gender"), F.col("script"), attempt))
        .when(kind == "account", F.concat(F.substring(norm, 1, 2), F.expr("substring(_shaped, 3)"), upper))
        .when(kind == "access", F.concat(F.lit("AKIA"), F.expr("substring(_shaped, 5)"), upper))
        .when(kind == "secret", F.concat(shaped, lower))
        .otherwise(F.concat(shaped, digits))
    )


def draw(atoms: DataFrame, key: bytes) -> DataFrame:
    hashed = hmac_sha256(F.concat_ws("\u0001", "kind", "norm", F.col("attempt").cast("string")), key)
    return (
        atoms.withColumn("_digest", hashed)
        .withColumn("_shaped", same_shape(F.col("norm"), F.col("_digest")))
        .withColumn("surrogate", surrogate(key))
        .select("kind", "norm", "gender", "script", "attempt", "surrogate")
    )


def assign(atoms: DataFrame, key: bytes, scratch: Scratch) -> DataFrame:
    """(kind, norm, surrogate): all distinct within a kind, none equal to a real value.

    Ends for any input: each round after the first few has many times the space of the
    round before, and fewer values to place.
    """
    drawn = scratch.keep(draw(atoms.withColumn("attempt", F.lit(0)), key))
    while True:
        written = F.lower("surrogate")
        first = drawn.groupBy("kind", written.alias("_low")).agg(F.min("norm").alias("_first"), F.count("*").alias("_n"))
        real = drawn.select("kind", F.lower("norm").alias("_low")).distinct().withColumn("_real", F.lit(True))
        taken = first.join(real, ["kind", "_low"], "left").where("_n > 1 OR _real")
        judged = drawn.withColumn("_low", written).join(taken, ["kind", "_low"], "left")
        bad = F.coalesce(F.col("_real") | ((F.col("_n") > 1) & (F.col("norm") != F.col("_first"))), F.lit(False))
        judged = judged.withColumn("_bad", bad)
        if judged.where("_bad").isEmpty():
            return drawn.select("kind", "norm", "surrogate")
        again = draw(judged.where("_bad").withColumn("attempt", F.col("attempt") + 1), key)
        fine = judged.where("NOT _bad").select(*drawn.columns)
        drawn = scratch.keep(fine.unionByName(again))


def atoms_of(kind: Column, value: Column) -> Column:
    """The atoms of a replaced part, in order: (kind, norm, gender, script)."""
    digits = F.regexp_replace(value, "[^0-9]", "")
    letters = F.upper(F.regexp_replace(value, "[^A-Za-z0-9]", ""))
    norm = (
        F.when(kind == "email", F.lower(value))
        .when(kind.isin("phone", "card", "social"), digits)
        .when(kind == "account", letters)
        .otherwise(value)
    )
    atom = lambda k, n: F.struct(k.alias("kind"), n.alias("norm"))
    words = F.split(value, " ")
    named = F.transform(
        words,
        lambda w, i: atom(F.when(i == F.size(words) - 1, "family").otherwise("given"), F.lower(w)),
    )
    return F.when(kind == "person", named).otherwise(F.array(atom(kind, norm)))


def written_like(original: Column, kind: Column, drawn: Column) -> Column:
    """The surrogates of a part, in the spacing, punctuation and case of the original."""
    first = F.element_at(drawn, 1)
    # Numbers: the original's separators stay, its digits (or letters) are taken in order.
    spread = F.array_join(
        F.transform(
            F.split(original, ""),
            lambda c, i: F.when(
                c.rlike("[A-Za-z0-9]"),
                F.substring(first, F.length(F.regexp_replace(F.substring(original, F.lit(1), i + 1), "[^A-Za-z0-9]", "")), F.lit(1)),
            ).otherwise(c),
        ),
        "",
    )
    # A surrogate longer than its value goes on behind it.
    rest = F.substring(first, F.length(F.regexp_replace(original, "[^A-Za-z0-9]", "")) + 1, F.length(first))
    name = F.array_join(drawn, " ")
    return (
        F.when(kind.isin("phone", "card", "social", "account"), F.concat(spread, rest))
        .when(kind == "person", F.when(original == F.upper(original), F.upper(name)).otherwise(name))
        .otherwise(F.array_join(drawn, " "))
    )


def replace_personal_data(docs: DataFrame, key: bytes, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` with new texts, under the same columns."""
    return counted(docs, key, text_col).select("row.*")


def later_mentions(parts: DataFrame, named: DataFrame) -> DataFrame:
    """(_id, _anew, _mentions): the gaps of texts in which a detected name stands again.

    ``named`` has (_id, norm, surrogate), the names detected in each text; only such texts
    are looked at. Words meet names by equality of text and spelling.
    """
    cut = parts.join(named.select("_id").distinct(), "_id", "left_semi").select("_id", F.posexplode("_gaps").alias("_g", "_gap"))
    cut = cut.select("_id", "_g", "_gap", gaps(F.col("_gap"), WORD).alias("_between"), matches(F.col("_gap"), WORD).alias("_words"))
    words = cut.select("_id", "_g", F.posexplode("_words").alias("_w", "_word")).withColumn("norm", F.lower("_word"))
    word = F.col("_word")
    spelled = F.when((word == F.upper(word)) & (word != F.initcap(word)), F.upper("surrogate")).otherwise(F.col("surrogate"))
    met = words.join(named, ["_id", "norm"], "left").withColumn("_new", F.coalesce(spelled, word))
    per_gap = met.groupBy("_id", "_g").agg(
        F.sort_array(F.collect_list(F.struct("_w", "_new"))).alias("_news"), F.count("surrogate").alias("_n")
    )
    before = F.expr("slice(_between, 1, size(_between) - 1)")
    spelled = F.concat(F.array_join(F.zip_with(before, F.col("_news._new"), lambda g, n: F.concat(g, n)), ""), F.element_at("_between", -1))
    fresh = F.when(F.col("_n") > 0, spelled).otherwise(F.col("_gap"))
    whole = cut.join(per_gap.where("_n > 0"), ["_id", "_g"], "left").groupBy("_id").agg(
        F.sort_array(F.collect_list(F.struct("_g", fresh.alias("_gap")))).alias("_all"), F.sum("_n").alias("_mentions")
    )
    return whole.where("_mentions > 0").select("_id", F.col("_all._gap").alias("_anew"), "_mentions")


def counted(docs: DataFrame, key: bytes, text_col: str = "text") -> DataFrame:
    """(row, n_entities): the whole row as a struct, its text replaced."""
    # The row travels as one struct, so no column of it can clash with those made here.
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    text = F.col("row").getField(text_col)
    found = F.coalesce(may_hold_some(text) & text.rlike(ANY), F.lit(False))
    plain = rows.where(~found).select("row", F.lit(0).cast("long").alias("n_entities"))
    with Scratch(docs.sparkSession, "surrogates") as scratch:
        return plain.unionByName(scratch.finish(_replaced(rows.where(found), text, key, text_col, docs.columns, scratch)))


def _replaced(rows: DataFrame, text: Column, key: bytes, text_col: str, columns: list[str], scratch: Scratch) -> DataFrame:
    """(row, n_entities) of rows that hold an entity."""
    others = F.struct(*[F.col("row").getField(c).alias(c) for c in columns if c != text_col]).alias("row") if len(columns) > 1 else F.struct(F.lit(None).alias("_none")).alias("row")
    parts = scratch.keep(
        rows.select(F.monotonically_increasing_id().alias("_id"), others, gaps(text, ANY).alias("_gaps"), matches(text, ANY).alias("_matches"))
    )
    hits = parts.select("_id", F.posexplode("_matches").alias("_pos", "_match")).withColumn("kind", kind_of(F.col("_match")))
    prefix = F.lit("")
    for kind, pattern in PREFIX.items():
        prefix = F.when(F.col("kind") == kind, F.regexp_extract("_match", pattern, 0)).otherwise(prefix)
    hits = hits.withColumn("_prefix", prefix).withColumn("_value", F.expr("substring(_match, length(_prefix) + 1)"))
    title = F.regexp_replace(F.trim("_prefix"), r"\.$", "")
    gender = F.when(title.isin(*MALE), "male").when(title.isin(*FEMALE), "female").otherwise("any")
    script = F.when(F.col("_value").rlike(r"\p{IsCyrillic}"), "cyrillic").when(F.col("_value").rlike(r"\p{IsGreek}"), "greek").otherwise("latin")
    hits = scratch.keep(
        hits.select("_id", "_pos", "kind", "_prefix", "_value", gender.alias("gender"), script.alias("script"), atoms_of(F.col("kind"), F.col("_value")).alias("_atoms"))
    )
    placed = hits.select("_id", "_pos", F.posexplode("_atoms").alias("_n", "_atom"), "gender", "script").select(
        "_id", "_pos", "_n", F.col("_atom.kind").alias("kind"), F.col("_atom.norm").alias("norm"), "gender", "script"
    )
    # A name met with and without a telling title takes the telling one.
    atoms = placed.groupBy("kind", "norm").agg(F.max(F.when(F.col("gender") != "any", F.col("gender"))).alias("gender"), F.max("script").alias("script"))
    table = assign(atoms.withColumn("gender", F.coalesce("gender", F.lit("any"))), key, scratch)
    spelled = placed.join(table, ["kind", "norm"])
    drawn = spelled.groupBy("_id", "_pos").agg(F.sort_array(F.collect_list(F.struct("_n", "surrogate"))).alias("_drawn"))
    fresh = F.concat("_prefix", written_like(F.col("_value"), F.col("kind"), F.col("_drawn.surrogate")))
    per_row = (
        hits.join(drawn, ["_id", "_pos"])
        .groupBy("_id")
        .agg(F.sort_array(F.collect_list(F.struct("_pos", fresh.alias("_new")))).alias("_news"))
    )
    # A word that is a given name here and a family name there counts as the latter.
    named = spelled.where(F.col("kind").isin("given", "family")).groupBy("_id", "norm").agg(F.min_by("surrogate", "kind").alias("surrogate"))
    again = later_mentions(parts, named)
    laid = parts.join(per_row, "_id").join(again, "_id", "left").withColumn("_rest", F.coalesce("_anew", "_gaps"))
    joined = F.array_join(
        F.concat(F.zip_with(F.expr("slice(_rest, 1, size(_rest) - 1)"), F.col("_news._new"), lambda g, n: F.concat(g, n)), F.expr("slice(_rest, size(_rest), 1)")), ""
    )
    return laid.select(
        F.struct(*[(joined if c == text_col else F.col("row").getField(c)).alias(c) for c in columns]).alias("row"),
        (F.size("_news") + F.coalesce("_mentions", F.lit(0))).cast("long").alias("n_entities"),
    )
