"""Personal data replaced by keyed surrogates of the same type and format, one to one over the corpus."""

from __future__ import annotations

import hashlib
import unicodedata
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..runtime import stage
from .common import fresh, let

# What is looked for. Runs are entered at their start only and read possessively, so scans are linear.
_OCTET = r"(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)"
_TITLES = {
    "m": ("Mr", "MR", "Mister", "Sir", "Lord", "Herr", "Herrn", "Monsieur", "Señor", "Don", "Signor", "Господин", "Г-н", "Κύριος", "Κύριε"),
    "f": ("Mrs", "MRS", "Ms", "MS", "Miss", "Madam", "Lady", "Dame", "Frau", "Madame", "Mme", "Mademoiselle", "Mlle", "Señora", "Señorita",
          "Doña", "Signora", "Госпожа", "Г-жа", "Κυρία"),
    "n": ("Dr", "DR", "Doctor", "Doktor", "Docteur", "Prof", "Professor", "Mx", "Rev", "Reverend", "Capt", "Captain", "Col", "Colonel",
          "Lt", "Lieutenant", "Sgt", "Sergeant", "Senator", "Доктор", "Профессор"),
}
_TITLE_WORD = "(?:" + "|".join(t for side in _TITLES.values() for t in side) + ")"
_ONE_TITLE = rf"{_TITLE_WORD}(?:\.[ \u00A0]{{0,2}}|[ \u00A0]{{1,2}})"
_TITLE = f"(?:{_ONE_TITLE}){{1,3}}"
# Words of a name: O'Brien, McDonald and Anne-Marie are one; the 's of a possessive is none of it.
_INSIDE = r"['’](?!(?:s|d|ll|re|ve|m|t)(?!\p{L}))(?=\p{L})"
_WORD = rf"\p{{Lu}}(?:[\p{{L}}\p{{M}}]++|(?={_INSIDE}))(?:{_INSIDE}[\p{{L}}\p{{M}}]++)*+(?:-\p{{Lu}}[\p{{L}}\p{{M}}]*+)*+"
_PARTICLE = (r"(?:(?:van|von|vom|de|del|della|dalla|degli|di|da|dal|dos|das|du|bin|ibn|ben|bint|abu|al|el|ter|te|af|av)\x20"
             r"(?:(?:und\x20zu|der|den|dem|het|la|las|los)\x20)?|[ae]l-|[dl]['’])")
_INITIAL = r"\p{Lu}(?:\.[ \u00A0-]?|[ \u00A0])"
_NAMED = rf"(?:{_INITIAL}|{_PARTICLE}){{0,4}}{_WORD}"
_SUFFIX = r"(?:Jr|Sr|II|III|IV|Esq|PhD|MD)(?!\p{L})"
PATTERNS = {
    "email": (r"(?<![\p{L}\p{N}._%+-])[\p{L}\p{N}._%+-]++(?:'[\p{L}\p{N}._%+-]++){0,3}+@"
              r"(?:[\p{L}\p{N}-]++\.){1,127}\p{L}{2,24}(?![\p{L}\p{N}])"),
    "ip": rf"(?<![\w.]){_OCTET}(?:\.{_OCTET}){{3}}(?!\w|\.\d)",
    "ssn": r"(?<![\w-])\d{3}-\d{2}-\d{4}(?![\w-])",
    "phone": (r"(?<![\w+])(?<!\d\.)(?:"
              r"(?:\+?1[ .-]?)?(?:\(?\d{3}\)?(?:[ .-]\d{3}[ .-]|[ -]\d{3})\d{4}|\(\d{3}\)\d{3}[ .-]?\d{4})"
              r"|\+?1[ .-]?\d{10}(?!\.\d)|\d{6}-\d{4}|(?:[02-9]\d{9}|0\d{10})(?!\.\d)"
              r"|0[1-9](?:[ .-]\d{2}){4}|\(?0\d{2,4}\)?[ -]\d{3,4}[ -]\d{3,4}"
              r"|\+[1-9](?:[ .-]?\(?\d\)?){6,14}|00[1-9](?:[ .-]?\(?\d\)?){8,14})(?!\w)"),
    "card": r"(?<![\w.+])\d(?:[ -]?\d){12,18}(?!\w)",
    "iban": r"(?<!\w)[A-Z]{2}\d{2}(?:\x20?[A-Z0-9]{4}){3,7}(?:\x20?[A-Z0-9]{1,3})?(?!\w)",
    "name": rf"(?<![\w\p{{L}}]){_TITLE}{_NAMED}(?:[ \u00A0](?!{_ONE_TITLE}|{_SUFFIX}){_NAMED}){{0,5}}",
}
ANY = "|".join(f"(?:{p})" for p in PATTERNS.values())
# A text without a digit, an at sign or a title has no entity.
_HINT = rf"[0-9@]|{_TITLE_WORD}[. \u00A0]"
# Parts of surrogate names by script; given names by gender too.
_GIVEN = {
    "m:latin": ("adam", "bruno", "carl", "david", "emil", "felix", "georg", "hugo", "ivan", "jonas"),
    "f:latin": ("alma", "berta", "clara", "diana", "emma", "flora", "greta", "helena", "irma", "julia"),
    "n:latin": ("alex", "chris", "eli", "jo", "kim", "lou", "max", "noa", "robin", "sasha"),
    "m:cyrillic": ("антон", "борис", "виктор", "глеб", "денис", "егор", "игорь", "кирилл", "лев", "марк"),
    "f:cyrillic": ("алла", "берта", "вера", "галина", "дарья", "ева", "инна", "кира", "лидия", "мария"),
    "n:cyrillic": ("валя", "женя", "никита", "паша", "саша", "слава", "тоня", "шура"),
    "m:greek": ("αδάμ", "βίκτωρ", "γιάννη", "δημήτρη", "ηλία", "κώστα", "λουκά", "μάρκο"),
    "f:greek": ("άννα", "βέρα", "γεωργία", "διάνα", "ελένη", "ζωή", "ιωάννα", "μαρία"),
    "n:greek": ("άγγελ", "άλεξ", "ρόμπιν", "φώτη"),
    "m:armenian": ("արամ", "գագիկ", "դավիթ", "կարեն", "հակոբ", "տիգրան"),
    "f:armenian": ("անի", "լիլիթ", "մարի", "նարե", "սոնա", "շուշան"),
    "n:armenian": ("արմեն", "արփի", "նաիրի"),
}
_SYLLABLES = {
    "latin": ("ba", "den", "fo", "gar", "hel", "ki", "lam", "mor", "nel", "pas", "ro", "sil", "tan", "ver", "win", "zol"),
    "cyrillic": ("ба", "ден", "фо", "гар", "хел", "ки", "лам", "мор", "нел", "пас", "ро", "сил", "тан", "вер", "вин", "зол"),
    "greek": ("βα", "δεν", "φο", "γαρ", "χελ", "κι", "λαμ", "μορ", "νελ", "πα", "ρο", "σιλ", "ταν", "βερ", "γιν", "ζολ"),
    "armenian": ("բա", "դեն", "ֆո", "գար", "հել", "կի", "լամ", "մոր", "նել", "պա", "րո", "սիլ", "տան", "վեր", "վին", "զոլ"),
}
_CALLING = r"^(?:1|7|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58]|\d{3})"


def _initials(key: str) -> tuple[str, str]:
    """Capital letters, and the letter of the same script that each one becomes: none itself, no two the same."""
    groups: dict[tuple, list[str]] = {}
    for c in map(chr, range(0x41, 0x590)):
        if unicodedata.category(c) == "Lu":
            groups.setdefault((unicodedata.name(c).split()[0], c < "\x80"), []).append(c)
    old = new = ""
    for letters in groups.values():
        ring = sorted(letters, key=lambda c: hashlib.sha256(f"{key}|initial|{c}".encode()).digest())
        old, new = old + "".join(ring), new + "".join(ring[1:] + ring[:1])
    return old, new


def _choice(values, number: Column) -> Column:
    return F.get(F.array(*[F.lit(v) for v in values]), F.pmod(number, F.lit(len(values))).cast("int"))


def _byte(stream: Column, i: Column) -> Column:
    """The i-th of a stream of 64 bytes in hexadecimal, from 0, beginning again at its end."""
    return F.conv(F.substr(stream, F.pmod(i, F.lit(64)) * 2 + 1, F.lit(2)), 16, 10).cast("int")


def _alike(text: Column, stream: Column) -> Column:
    """Letters for letters and digits for digits; all else stays."""
    def one(i):
        c, n = F.substr(text, i + 1, F.lit(1)), _byte(stream, i)
        return (F.when(c.rlike(r"\p{N}"), F.pmod(n, F.lit(10)).cast("string"))
                .when(c.rlike(r"\p{Lu}"), F.char(F.lit(65) + F.pmod(n, F.lit(26))))
                .when(c.rlike(r"\p{L}"), F.char(F.lit(97) + F.pmod(n, F.lit(26)))).otherwise(c))

    return F.when(F.length(text) > 0, F.array_join(F.transform(F.sequence(F.lit(0), F.length(text) - 1), one), "")).otherwise(text)


def _luhn(digits: Column) -> Column:
    def weighed(i):
        d = F.substr(digits, F.length(digits) - i, F.lit(1)).cast("int")
        two = d * 2
        return F.when(i % 2 == 0, d).otherwise(F.when(two > 9, two - 9).otherwise(two))

    return F.aggregate(F.transform(F.sequence(F.lit(0), F.length(digits) - 1), weighed), F.lit(0), lambda a, x: a + x) % 10


def kind_of(mention: Column) -> Column:
    out = F.lit("card")
    for kind in ("phone", "iban", "ssn", "ip", "name", "email"):
        out = F.when(mention.rlike(f"^(?:{PATTERNS[kind]})$"), kind).otherwise(out)
    return out


def canonical(kind: Column, mention: Column) -> Column:
    """What mentions of one entity share: digits (of phones without 1 or +1, else from + on), lower case. Not for names."""
    digits = F.regexp_replace(mention, "[^0-9]", "")
    called = F.regexp_replace(F.regexp_replace(mention, r"\(0\)", ""), "[^0-9]", "")
    abroad = mention.startswith("+") | (mention.startswith("00") & (F.length(digits) > 11))
    phone = F.when(called.rlike(r"^(?:00)?1\d{10}$"), F.right(called, F.lit(10))).when(
        abroad, F.concat(F.lit("+"), F.regexp_replace(called, "^00", ""))).otherwise(digits)
    return (F.when(kind == "email", F.lower(mention)).when(kind == "ip", mention).when(kind == "phone", phone)
            .when(kind == "iban", F.regexp_replace(mention, " ", "")).otherwise(digits))


def pieces(kind: Column, mention: Column, key: str) -> Column:
    """The entities of a mention as structs (before, piece, kind, canon), ``before`` being what is written ahead of each.

    A name's words are entities of their own: the last one a family (script and word), the others given names (gender
    of the title, script and word). Initials are written as other letters in ``before``; titles and particles stay.
    """
    old, new = _initials(key)

    def named(title, body):
        side = F.lit("n")
        for g in "fm":
            side = F.when(title.rlike(r"(?<!\p{L})(?:" + "|".join(_TITLES[g]) + r")(?!\p{L})"), g).otherwise(side)
        return let(side, lambda g: let(F.regexp_extract_all(body, F.lit(_WORD), 0), lambda words: let(
            F.split(body, _WORD, -1), lambda gaps: F.transform(words, lambda w, i: one(title, g, words, gaps, w, i)))))

    def one(title, g, words, gaps, w, i):
        script = F.lit("latin")
        for name in ("Armenian", "Greek", "Cyrillic"):
            script = F.when(w.rlike(rf"\p{{Is{name}}}"), name.lower()).otherwise(script)
        plain = F.concat_ws(":", script, F.lower(F.translate(w, "’", "'")))
        last = i == F.size(words) - 1
        before = F.concat(F.when(i == 0, title).otherwise(""), F.translate(F.get(gaps, i), old, new))
        return F.struct(before.alias("before"), w.alias("piece"), F.when(last, "family").otherwise("given").alias("kind"),
                        F.when(last, plain).otherwise(F.concat_ws(":", g, plain)).alias("canon"))

    names = let(F.regexp_extract(mention, f"^{_TITLE}", 0), lambda t: let(
        F.substr(mention, F.length(t) + 1), lambda b: named(t, b)))
    single = F.array(F.struct(F.lit("").alias("before"), mention.alias("piece"), kind.alias("kind"), canonical(kind, mention).alias("canon")))
    return F.when(kind == "name", names).otherwise(single)


def _untold(entities: DataFrame) -> DataFrame:
    """(canon, told): given names after a title of either gender that also follow one that tells it ('Dr Jane', 'Mrs Jane')."""
    given = entities.where("kind = 'given'").select(
        "canon", F.left("canon", F.lit(1)).alias("g"), F.expr("substr(canon, 3)").alias("name"))
    told = given.where("g <> 'n'").groupBy("name").agg(F.min("canon").alias("told"))
    return given.where("g = 'n'").join(told, "name").select("canon", "told")


def _family(stream: Column, attempt: Column, syllables) -> Column:
    return F.array_join(F.transform(
        F.sequence(F.lit(0), attempt + 2), lambda i: _choice(syllables, _byte(stream, i + 1))), "")


# Rounds in which an email keeps its length; each later one adds a letter, so that crowded shapes find room.
_SHORT_ROUNDS = 4


def _surrogate(kind: Column, canon: Column, attempt: Column, key: str) -> Column:
    seed = F.concat_ws("|", F.lit(key), kind, attempt, canon)
    stream = F.concat(F.sha2(seed, 256), F.sha2(F.concat(seed, F.lit("|more")), 256))
    longer = F.left(F.translate(F.md5(F.concat(seed, F.lit("|longer"))), "0123456789", "ghijklmnop"), attempt - _SHORT_ROUNDS + 1)

    def made(s):
        tail = F.regexp_extract(canon, r"\.\p{L}+$", 0)
        email = F.concat(longer, _alike(F.substr(canon, F.lit(1), F.length(canon) - F.length(tail)), s), tail)
        octets = F.array_join(F.transform(F.sequence(F.lit(0), F.lit(3)), lambda i: (F.pmod(_byte(s, i), F.lit(254)) + 1).cast("string")), ".")
        card = F.concat(F.left(canon, F.lit(1)), _alike(F.substr(canon, F.lit(2), F.length(canon) - 2), s))
        check = F.concat(card, F.pmod(-_luhn(F.concat(card, F.lit("0"))), F.lit(10)).cast("string"))
        card = F.when(_luhn(canon) == 0, check).otherwise(_alike(canon, s))
        names = F.lit(None).cast("string")
        for script, syllables in _SYLLABLES.items():
            family = _family(s, attempt, syllables)
            names = F.when(canon.startswith(f"{script}:"), F.concat(F.lit(f"{script}:"), family)).otherwise(names)
            for group in (g for g in _GIVEN if g.endswith(f":{script}")):
                names = F.when(canon.startswith(f"{group}:"), F.concat(
                    F.lit(f"{group}:"), _choice(_GIVEN[group], _byte(s, F.lit(0))), family)).otherwise(names)
        code = F.regexp_extract(F.substr(canon, F.lit(2)), _CALLING, 0)
        abroad = F.concat(F.lit("+"), code, _alike(F.substr(canon, F.length(code) + 2), s))
        return (F.when(kind == "email", email).when(kind == "ip", octets).when(kind == "card", card)
                .when(kind.isin("family", "given"), names).when((kind == "phone") & canon.startswith("+"), abroad)
                .when(kind == "iban", F.concat(F.left(canon, F.lit(2)), _alike(F.substr(canon, F.lit(3), F.length(canon) - 2), s)))
                .otherwise(_alike(canon, s)))

    return let(stream, made)


def _written(kind: Column, mention: Column, surrogate: Column) -> Column:
    """The surrogate in the mention's own format: separators, capitals and country code stay."""
    def fill(pattern, mention=mention, surrogate=surrogate):
        slots = F.regexp_count(mention, F.lit(pattern))
        kept = slots - F.length(surrogate)
        return F.aggregate(
            F.transform(F.sequence(F.lit(1), F.length(mention)), lambda i: F.substr(mention, i, F.lit(1))),
            F.struct(F.lit(0).alias("k"), F.lit("").alias("out")),
            lambda a, c: F.when(c.rlike(pattern), F.struct(
                (a["k"] + 1).alias("k"),
                F.concat(a["out"], F.when(a["k"] < kept, c).otherwise(F.substr(surrogate, a["k"] - kept + 1, F.lit(1)))).alias("out")))
            .otherwise(F.struct(a["k"].alias("k"), F.concat(a["out"], c).alias("out"))))["out"]

    cased = F.array_join(F.transform(F.sequence(F.lit(1), F.length(mention)), lambda i: F.when(
        F.substr(mention, i, F.lit(1)).rlike("[A-Z]"), F.upper(F.substr(surrogate, i, F.lit(1)))).otherwise(F.substr(surrogate, i, F.lit(1)))), "")
    cased = F.when(F.length(surrogate) == F.length(mention), cased).otherwise(surrogate)
    word = F.substring_index(surrogate, ":", -1)
    name = F.when((F.upper(mention) == mention) & (F.length(mention) > 1), F.upper(word)).otherwise(F.initcap(word))
    # The zero of '+44 (0)20' is no slot.
    phone = F.replace(fill("[0-9]", F.replace(mention, F.lit("(0)"), F.lit("(\0)")), F.ltrim(surrogate, F.lit("+"))), F.lit("(\0)"), F.lit("(0)"))
    return (F.when(kind == "email", cased).when(kind == "ip", surrogate).when(kind.isin("family", "given"), name)
            .when(kind == "phone", phone).when(kind == "iban", fill("[A-Z0-9]")).otherwise(fill("[0-9]")))


def surrogates(entities: DataFrame, key: str, max_rounds: int = 60) -> DataFrame:
    """One surrogate for each distinct (kind, canon), none of them given twice or equal to an entity of the corpus.

    Every entity draws by its keyed hash. Draws that meet (of those that meet, the smallest entity keeps it) or
    that name a real entity draw again. Rounds are written tables; few entities need a second one. Names and emails
    grow with the rounds, so they always find room. Only where ``max_rounds`` rounds in a row give nobody a surrogate
    (digits of a fixed length, all of them taken) is the corpus refused.
    """
    spark = entities.sparkSession
    real = stage(entities.distinct(), "entities")
    waiting, done, idle = real.withColumn("attempt", F.lit(0)), [], 0
    while idle < max_rounds:
        drawn = stage(waiting.withColumn("surrogate", _surrogate(F.col("kind"), F.col("canon"), F.col("attempt"), key)), "draws")
        clash = drawn.alias("x").join(real.alias("y"), F.expr("x.kind = y.kind AND x.surrogate = y.canon"), "left").select(
            "x.*", F.col("y.canon").isNotNull().alias("bad"))
        if done:
            old = reduce(DataFrame.union, done).select(F.col("kind").alias("k"), F.col("surrogate").alias("s"))
            clash = clash.join(old, F.expr("kind = k AND surrogate = s"), "left").withColumn("bad", F.col("bad") | F.col("s").isNotNull()).drop("k", "s")
        first = clash.where("NOT bad").groupBy("kind", "surrogate").agg(F.min("canon").alias("winner"))
        judged = stage(clash.join(first, ["kind", "surrogate"], "left").withColumn(
            "won", ~F.col("bad") & F.coalesce(F.col("winner") == F.col("canon"), F.lit(False))), "draws")
        won = judged.where("won").select("kind", "canon", "surrogate")
        idle = idle + 1 if won.isEmpty() else 0
        if not idle:
            done.append(won)
        waiting = judged.where("NOT won").select("kind", "canon", (F.col("attempt") + 1).alias("attempt"))
        if waiting.isEmpty():
            break
    else:
        raise ValueError(f"entities without a surrogate: none was free in {max_rounds} rounds")
    return reduce(DataFrame.union, done) if done else spark.createDataFrame([], "kind string, canon string, surrogate string")


def replace_pii(docs: DataFrame, key: str, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """``docs`` with every found entity replaced by its surrogate, and ``n_entities``.

    Mentions are found inside each row (one pattern, leftmost, non-overlapping). Distinct entities draw surrogates
    once for the whole corpus, so mentions of one entity, however written, stay one, and two never become one. The
    surrogates are joined to the mentions (a third of the rows may name one entity: Spark splits that join), and
    the mentions to their document, where the texts between them are put together again.

    Every word of a name is an entity, so no two families (or given names of a gender) of a script are written alike, and
    a family keeps its surrogate with or without a given name. Phones, cards and numbers keep separators and country code,
    a card its first digit and check sum, an email its shape and top domain, a name title, particles, script and (given
    names) gender; Latin names stand for scripts other than Cyrillic, Greek and Armenian. An initial becomes
    another letter and is not linked with full given names; a name of one word after its title counts as a family.

    Not detected, so left as it is: names without a title of ``_TITLES`` (or in lower case, in scripts without capitals, of single
    letters, on the next line), the seventh and later words of a name and suffixes (Jr); emails with quoted or rare signs in the local
    part, or a numeric host; phones without country code beyond 3-3-4, unseparated ten digits (not from 1 on) and
    leading zeros, and extensions; IPv6; addresses, dates of birth and other kinds of ids. A capitalised word after a name is taken
    for a part of it, ten digits for a phone; national and international writings of a phone abroad count as two.

    Null or empty text and texts without entities stay as they
    are. Null ids are an id of their own; repeated rows are rewritten alike; an empty table gives an empty
    result; an existing column ``n_entities`` is replaced.
    """
    plain = docs.drop("n_entities")
    at, d, p, news_ = (fresh(plain, name) for name in ("_print", "_of", "_as", "_news"))
    hinted = F.when(F.col(text).rlike(_HINT), F.regexp_extract_all(text, F.lit(ANY), 0))
    mentions = (plain.select(F.col(doc_id).alias("d"), F.xxhash64(text).alias("p"), F.posexplode(hinted).alias("at", "mention"))
                .withColumn("kind", kind_of(F.col("mention")))
                .select("d", "p", "at", F.posexplode(pieces(F.col("kind"), F.col("mention"), key)).alias("j", "x"))
                .select("d", "p", "at", "j", "x.*"))
    mentions = stage(mentions, "mentions")
    entities = stage(mentions.select("kind", "canon").distinct(), "entities")
    untold = stage(_untold(entities), "untold")
    drawn = surrogates(entities.join(untold.select(F.lit("given").alias("kind"), "canon"), ["kind", "canon"], "left_anti"), key)
    mapping = drawn.select("kind", "canon", "surrogate").union(
        untold.join(drawn.where("kind = 'given'").select(F.col("canon").alias("told"), "surrogate"), "told").select(
            F.lit("given").alias("kind"), "canon", "surrogate"))
    news = (mentions.join(mapping, ["kind", "canon"])
            .withColumn("new", F.concat("before", _written(F.col("kind"), F.col("piece"), F.col("surrogate"))))
            .groupBy(F.col("d").alias(d), F.col("p").alias(p)).agg(F.sort_array(F.collect_set(F.struct("at", "j", "new"))).alias(news_)))
    joined = plain.withColumn(at, F.xxhash64(text)).join(
        news, plain[doc_id].eqNullSafe(F.col(d)) & (F.col(at) == F.col(p)), "left")
    # The text before a mention goes ahead of its first piece.
    rebuilt = let(F.split(text, ANY, -1), lambda gaps: F.concat(F.array_join(F.transform(news_, lambda x: F.concat(
        F.when(x["j"] == 0, F.get(gaps, x["at"])).otherwise(""), x["new"])), ""), F.element_at(gaps, -1)))
    return joined.select(
        *[F.when(F.col(news_).isNull(), F.col(text)).otherwise(rebuilt).alias(text) if c == text else plain[c] for c in plain.columns],
        F.coalesce(F.size(F.filter(news_, lambda x: x["j"] == 0)), F.lit(0)).cast("long").alias("n_entities"))
