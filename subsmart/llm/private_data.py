"""Personal data replaced by keyed surrogates, with DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from subsmart.llm.tables import read, stored
from subsmart.operators.spread import sized

_OCTET = r"(?:25[0-5]|2[0-4]\d|1?\d?\d)"
# Titles by gender; the name that follows is taken with them.
MALE = ["Mr", "Herr", "Señor", "Sr", "Monsieur", "Signor", "Господин", "Κύριος"]
FEMALE = ["Mrs", "Ms", "Miss", "Frau", "Señora", "Sra", "Madame", "Mme", "Signora", "Госпожа", "Κυρία"]
NEUTRAL = ["Dr", "Prof"]
_TITLE = "(?:" + "|".join(sorted(MALE + FEMALE + NEUTRAL, key=len, reverse=True)) + ")"
# A name ends with a letter, without the s of a possessive.
_NAME = r"\p{Lu}(?:\p{L}|['’\-](?=\p{L})(?![sS](?!\p{L})))++"
_WORD = rf"(?<!\p{{L}}){_NAME}"
# Given names by which a person is found without a title; those of GIVEN count as well.
KNOWN = {
    "m": "Andrew Anthony Brian Charles Christopher Daniel Donald Edward Eric Frank George Hans Henry Jack Jacob James Jason Jean "
    "Jeffrey John Joseph José Juan Jürgen Kenneth Kevin Klaus Luis Mark Matthew Michael Miguel Peter Pierre Richard Robert Ronald "
    "Ryan Stephen Steven Thomas Timothy William Wolfgang",
    "f": "Amanda Amy Angela Anna Barbara Carmen Carol Catherine Christine Deborah Elizabeth Emily Helen Isabel Jennifer Jessica "
    "Karen Katharina Kathleen Linda Lisa Lucía Margaret Marie Mary Michelle Monika Nancy Pamela Patricia Rebecca Ruth Sandra "
    "Sarah Sharon Stephanie Susan Teresa Ursula",
}
GIVEN = {
    "Latin": {
        "m": "Adam Bruno Carl David Emil Felix Georg Hugo Ivan Jonas Karl Leo Max Noah Oscar Paul Ralf Simon Tom Victor",
        "f": "Alice Berta Clara Diana Emma Flora Greta Hanna Irene Julia Karla Laura Maria Nora Olga Paula Rosa Sofia Tina Vera",
        "n": "Alex Charlie Dominique Eden Jamie Jules Kim Lou Micha Robin Sacha Sam Toni Vivian Yael",
    },
    "Cyrillic": {
        "m": "Андрей Борис Виктор Глеб Денис Егор Иван Кирилл Леонид Максим Никита Олег Павел Роман Сергей",
        "f": "Анна Вера Галина Дарья Елена Жанна Зоя Ирина Ксения Лидия Мария Нина Ольга Полина Софья",
        "n": "Женя Саша Валя Слава Шура",
    },
    "Greek": {
        "m": "Αλέξης Γιώργος Δημήτρης Ηλίας Κώστας Λεωνίδας Μάριος Νίκος Πέτρος Σταύρος",
        "f": "Άννα Βασιλική Γεωργία Δήμητρα Ελένη Ζωή Ιωάννα Κατερίνα Μαρία Σοφία",
        "n": "Αλεξ Κρις Μελ",
    },
}
# Surnames are put together from syllables.
SYLLABLES = {
    "Latin": "ba be bo da de do fa fe ga go ha he ka ke ko la le lo ma me mo na ne no pa pe ra re ro sa se so ta te to va ve wa we zo".split(),
    "Cyrillic": "ба бе бо ва ве во да де до ка ке ко ла ле ло ма ме мо на не но па пе по ра ре ро са се со та те то".split(),
    "Greek": "βα βε βο γα δα δε κα κε κο λα λε λο μα με μο να νε νο πα πε ρα ρε ρο σα σε σο τα τε το".split(),
}
GENDERS = {
    gender: [*KNOWN.get(gender, "").split(), *(name for lists in GIVEN.values() for name in lists[gender].split())]
    for gender in ("m", "f", "n")
}
_GIVEN = "(?:" + "|".join(sorted({name for names in GENDERS.values() for name in names}, key=lambda x: (-len(x), x))) + ")"
_KEY = (
    r"(?i:password|passwd|pwd|passphrase|secret|token|(?:api|access|private|secret)[_\-]?key)"
    r"[\"']?\s*+[=:]\s*+(?:(?i:bearer|basic)\s++)?+"
)
_PEM = r"-----{0} [A-Z ]{{0,30}}PRIVATE KEY-----"
# What stands around the value of a secret and stays.
_FRONT = rf"(?:{_KEY}[\"']?|(?i:bearer)\s++|{_PEM.format('BEGIN')})"
_BACK = rf"(?:[\"']|{_PEM.format('END')})"
# By these beginnings secrets are known without a key word; they stay too.
_MARK = r"(?:A[KS]IA(?=[A-Z0-9]{16}$)|gh[pousr]_|sk-|xox[abprs]-|AIza|eyJ)"
# A secret has a letter or digit, of any script; asterisks in place of one are none.
_CHANGING = r"(?=[^\s\"'\p{L}\p{Nd}]*+[\p{L}\p{Nd}])"
_QUOTED = r"{0}(?=[^{0}\p{{L}}\p{{Nd}}\r\n]*+[\p{{L}}\p{{Nd}}])[^{0}\\\r\n]*+(?:\\.[^{0}\\\r\n]*+)*+{0}"
_H = "[0-9A-Fa-f]{1,4}"

# Kinds of entities in the order in which they are tried.
KINDS = {
    "secret": rf"(?<![A-Za-z0-9])(?:{_KEY}(?:{_QUOTED.format(chr(34))}|{_QUOTED.format(chr(39))}"
    rf"|[\"']?(?:{_CHANGING}[^\s\"']{{6,}}+|(?=[^\s\"'\d]{{0,4}}\d)[^\s\"']{{3,5}}+(?![^\s\"'])))"
    r"|(?i:bearer)\s++(?=[A-Za-z._~+/\-]*+\d)[A-Za-z0-9._~+/\-]{8,}+=*+"
    rf"|{_PEM.format('BEGIN')}[^\-]++(?:{_PEM.format('END')})?+"
    r"|(?:A[KS]IA[A-Z0-9]{16}|gh[pousr]_[A-Za-z0-9]{20,}+|sk-[A-Za-z0-9_\-]{20,}+|xox[abprs]-[A-Za-z0-9\-]{10,}+"
    r"|AIza[A-Za-z0-9_\-]{30,}+|eyJ[A-Za-z0-9_\-]{8,}+\.[A-Za-z0-9_\-]++\.[A-Za-z0-9_\-]++)(?![A-Za-z0-9]))",
    # A host has 127 labels at most by its standard.
    "email": r"(?<![\p{L}\p{N}._%+\-])[\p{L}\p{N}._%+\-]++@(?:[\p{L}\p{N}\-]++\.){1,126}\p{L}{2,24}",
    "iban": r"(?<![A-Za-z0-9])[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])",
    "ssn": r"(?<![\d\-])\d{3}-\d{2}-\d{4}(?![\d\-])",
    "ip": rf"(?<![\d.])(?:{_OCTET}\.){{3}}{_OCTET}(?!\d|\.\d)",
    "ipv6": rf"(?<![\w:.])(?=[A-Fa-f:]*+\d)(?:(?:{_H}:){{7}}{_H}|(?:{_H}:){{1,6}}(?::{_H}){{1,6}})(?![\w:])",
    "phone": r"(?<![\w+])\+\d{1,3}[ .\-]?(?:\(\d{1,4}\)|\d{1,4})(?:[ .\-]?\d{2,4}){2,4}(?!\d)"
    r"|(?<![\w(])\(\d{3}\)[ .\-]?\d{3}[ .\-]?\d{4}(?!\d)"
    r"|(?<![\w.\-])\d{3}[ .\-]\d{3}[ .\-]\d{4}(?![\w]|[.\-]\d)"
    r"|(?<![\w.\-])[2-9]\d{2}[2-9]\d{6}(?![\w]|[.\-]\d)",
    "card": r"(?<![\d])(?:\d[ \-]?){12,18}\d(?!\d)",
    "person": rf"(?<!\p{{L}})(?:{_TITLE}\.?(?: {_NAME}){{1,4}}+|(?=\p{{Lu}}\p{{Ll}}++ \p{{Lu}}){_GIVEN}(?: {_NAME}){{1,3}}+)",
}
_ONE = {kind: f"(?:{pattern})" for kind, pattern in KINDS.items()}
# Within a run of Latin letters only numbers can begin, which spares most places all attempts.
ANY = f"(?<![A-Za-z])(?:{'|'.join(_ONE.values())})|(?<=[A-Za-z])(?=\\d)(?:{_ONE['ssn']}|{_ONE['ip']}|{_ONE['card']})"

BYTES = 128
# Letters and digits of other scripts are replaced by those of the first alphabet that fits.
_ALPHABETS = {
    r"[\p{IsCyrillic}&&\p{Lu}]": "АБВГДЕЖЗИЙКЛМНОПРСТУФХЦЧШЩЭЮЯ",
    r"[\p{IsCyrillic}&&\p{L}]": "абвгдежзийклмнопрстуфхцчшщыьэюя",
    r"[\p{IsGreek}&&\p{Lu}]": "ΑΒΓΔΕΖΗΘΙΚΛΜΝΞΟΠΡΣΤΥΦΧΨΩ",
    r"[\p{IsGreek}&&\p{L}]": "αβγδεζηθικλμνξοπρστυφχψω",
    r"[\p{IsLatin}&&\p{Lu}]": "ÀÁÂÃÄÅÇÈÉÊËÌÍÎÏÑÒÓÔÕÖØÙÚÛÜÝ",
    r"[\p{IsLatin}&&\p{L}]": "àáâãäåçèéêëìíîïñòóôõöøùúûüý",
    r"\p{IsHebrew}": "אבגדהוזחטיכלמנסעפצקרשת",
    r"\p{IsArabic}": "ابتثجحخدذرزسشصضطظعغفقكلمنهوي",
    r"\p{IsDevanagari}": "कखगघचछजझटठडढतथदधनपफबभमयरलवशषसह",
    r"\p{IsThai}": "กขคงจฉชซญดตถทธนบปผฝพฟภมยรลวสหอ",
    r"\p{IsHiragana}": "あいうえおかきくけこさしすせそたちつてとなにぬねのはひふへほ",
    r"\p{IsKatakana}": "アイウエオカキクケコサシスセソタチツテトナニヌネノハヒフヘホ",
    r"\p{IsHangul}": "가나다라마바사아자차카타파하고노도로모보소오조초코토포호",
    r"\p{IsHan}": "一丁七上下不世中主久之也了事二人今他以们会作你使例先光全公共其",
    r"\p{Lu}": "ABCDEFGHIJKLMNOPQRSTUVWXYZ",
    r"\p{L}": "abcdefghijklmnopqrstuvwxyz",
}
_DIGITS = {
    "[٠-٩]": "٠١٢٣٤٥٦٧٨٩",
    "[۰-۹]": "۰۱۲۳۴۵۶۷۸۹",
    "[०-९]": "०१२३४५६७८९",
    "[０-９]": "０１２３４５６７８９",
    r"\p{Nd}": "0123456789",
}


def _digits(text: Column) -> Column:
    return F.regexp_replace(text, r"\D", "")


def mentions(texts: DataFrame) -> DataFrame:
    """Distinct ``mention`` and ``kind`` in the column ``text``."""
    return kinds(occurrences(texts.withColumn("_key", F.lit(""))).select("mention").distinct())


def occurrences(keyed: DataFrame) -> DataFrame:
    """``_key``, ``place`` and ``mention`` of every mention in ``text``, once for equal rows."""
    # Only the outer form keeps Spark from inferring a filter that would match all texts again.
    found = F.posexplode_outer(F.regexp_extract_all("text", F.lit(ANY), F.lit(0))).alias("place", "mention")
    return keyed.select("_key", found).filter("mention is not null").distinct()


def kinds(found: DataFrame) -> DataFrame:
    """``found`` with the ``kind`` of each ``mention``."""
    kind = F.lit(list(KINDS)[-1])
    for name, pattern in reversed(list(KINDS.items())[:-1]):
        kind = F.when(F.col("mention").rlike(f"^(?:{pattern})$"), name).otherwise(kind)
    return found.withColumn("kind", kind)


def _names_of(mention: Column) -> Column:
    return F.split(F.regexp_replace(mention, rf"^{_TITLE}\.? ", ""), " ")


def _like(text: Column, model: Column) -> Column:
    """``text`` in capitals if ``model`` is."""
    return F.when((F.length(model) > 1) & (F.upper(model) == model), F.upper(text)).otherwise(text)


def parts(found: DataFrame) -> DataFrame:
    """What of each mention is replaced: ``kind``, ``canonical``, ``variant``, ``place``, one row each.

    Writings of one thing have one ``canonical``: numbers their digits (a phone number its
    last ten), addresses lower case, account numbers no blanks, secrets the value without
    the key word and quotes, names lower case. Of a person, each name is a part, so the
    same surname is replaced alike with and without given name; ``variant`` has script and
    gender, by the title or else by the given name.
    """
    mention = F.col("mention")
    digits = _digits(mention)
    title = F.regexp_extract(mention, rf"^({_TITLE})\.? ", 1)
    names = _names_of(mention)
    first = F.initcap(F.get(names, 0))
    gender = (
        F.when(title.isin(MALE) | (~title.isin(FEMALE) & first.isin(GENDERS["m"])), "m")
        .when(title.isin(FEMALE) | first.isin(GENDERS["f"]), "f")
        .otherwise("n")
    )
    last = F.element_at(names, -1)
    script = F.when(last.rlike(r"^\p{IsCyrillic}"), "Cyrillic").when(last.rlike(r"^\p{IsGreek}"), "Greek").otherwise("Latin")
    row = lambda kind, canonical, variant, place: F.struct(
        kind.alias("kind"), canonical.alias("canonical"), variant.alias("variant"), place.alias("place")
    )
    persons = F.transform(
        names,
        lambda name, i: row(
            F.when(i == F.size(names) - 1, "surname").otherwise("given"),
            F.lower(name),
            F.concat_ws(" ", script, F.when(i == F.size(names) - 1, "").otherwise(gender)),
            i,
        ),
    )
    kind = F.col("kind")
    canonical = (
        F.when(kind == "phone", F.substring(digits, F.greatest(F.length(digits) - 9, F.lit(1)), F.lit(10)))
        .when(kind == "card", digits)
        .when(kind.isin("email", "ipv6"), F.lower(mention))
        .when(kind == "iban", F.replace(mention, F.lit(" ")))
        .when(kind == "secret", F.regexp_replace(mention, f"^{_FRONT}|{_BACK}$", ""))
        .otherwise(mention)
    )
    person = F.when(kind == "person", persons)
    one = F.array(row(kind, canonical, F.lit(""), F.lit(0)))
    return found.select("mention", F.explode(person.otherwise(one)).alias("p")).select(
        "mention", "p.*"
    )


def _byte(i: Column) -> Column:
    """Number ``i`` (from 0) of the row's keyed bytes."""
    at = F.pmod(i, F.lit(BYTES)).cast("int") * 2 + 1
    return F.conv(F.substring(F.col("_bytes"), at, F.lit(2)), 16, 10).cast("int")


def _letters(text: Column, low: Column) -> Column:
    """``text`` with every letter and digit replaced by one of its kind; ASCII digits from ``low``."""
    hexadecimal = text.rlike(r"^[0-9a-f]{8,}$") | (F.col("kind") == "ipv6")

    def one(c: Column, b: Column) -> Column:
        letter = lambda first, n: F.char(F.lit(ord(first)) + b % n)
        other = c
        for fits, alphabet in reversed([*_DIGITS.items(), *_ALPHABETS.items()]):
            picked = F.substring(F.lit(alphabet), b % len(alphabet) + 1, F.lit(1))
            other = F.when(c.rlike(fits), picked).otherwise(other)
        return (
            F.when(c.rlike("[0-9]"), (low + b % (10 - low)).cast("string"))
            .when(c.rlike("[a-z]"), F.when(hexadecimal, letter("a", 6)).otherwise(letter("a", 26)))
            .when(c.rlike("[A-Z]"), letter("A", 26))
            .when(c.rlike(r"[^\x00-\x7f]"), other)
            .otherwise(c)
        )

    characters = F.split(text, "")
    numbers = F.transform(characters, lambda c, i: _byte(i))
    return F.array_join(F.zip_with(characters, numbers, one), "")


def _luhn(digits: Column) -> Column:
    """Sum by which a card number is checked: 0 modulo 10 if valid."""
    doubled = F.transform(
        F.reverse(F.split(digits, "")),
        lambda c, i: F.when(
            i % 2 == 1, F.when(c.cast("int") >= 5, c.cast("int") * 2 - 9).otherwise(c.cast("int") * 2)
        ).otherwise(c.cast("int")),
    )
    return F.aggregate(doubled, F.lit(0), lambda total, x: total + x)


def _card(digits: Column, drawn: Column) -> Column:
    """The first digit stays; a number with a right check digit gets one with a right one."""
    body = F.concat(F.substring(digits, 1, 1), F.substring(drawn, F.lit(2), F.length(digits) - 2))
    check = (F.lit(10) - _luhn(F.concat(body, F.lit("0"))) % 10) % 10
    other = F.concat(body, F.pmod(check + 1 + _byte(F.lit(100)) % 9, F.lit(10)).cast("string"))
    return F.when(_luhn(digits) % 10 == 0, F.concat(body, check.cast("string"))).otherwise(other)


def _remainder(account: Column) -> Column:
    """An account number modulo 97, its first four characters last and letters as two digits: 1 if valid."""
    moved = F.concat(F.substring(account, F.lit(5), F.length(account)), F.substring(account, 1, 4))

    def step(total: Column, c: Column) -> Column:
        return F.when(c.rlike("[0-9]"), (total * 10 + c.cast("int")) % 97).otherwise((total * 100 + F.ascii(c) - 55) % 97)

    return F.aggregate(F.split(moved, ""), F.lit(0), step)


def _iban(text: Column, drawn: Column) -> Column:
    """Country and format stay; a number with right check digits gets one with right ones."""
    country, body = F.substring(text, 1, 2), F.substring(drawn, F.lit(3), F.length(drawn))
    check = F.lpad((98 - _remainder(F.concat(country, F.lit("00"), body))).cast("string"), 2, "0")
    return F.when(_remainder(text) == 1, F.concat(country, check, body)).otherwise(F.concat(country, drawn))


def _address(text: Column) -> Column:
    """A private address stays in its network, then in the largest; where those are full it gets the longer format."""
    octets = F.transform(F.sequence(F.lit(0), F.lit(3)), lambda i: (_byte(i) % 254 + 1).cast("string"))
    network = F.regexp_extract(text, r"^(10\.|127\.|192\.168\.|172\.(?:1[6-9]|2\d|3[01])\.|)", 1)
    network = F.when((network != "") & (F.col("attempt") >= 6), F.lit("10.")).otherwise(network)
    kept = F.size(F.split(network, r"\.")) - 1
    drawn = F.concat(network, F.array_join(F.slice(octets, kept + 1, 4 - kept), "."))
    groups = F.transform(F.sequence(F.lit(0), F.lit(6)), lambda i: F.substring("_bytes", i * 4 + 1, F.lit(4)))
    return F.when(F.col("attempt") < 12, drawn).otherwise(F.concat(F.lit("fd00:"), F.array_join(groups, ":")))


def _pick(names: list[str], i: Column) -> Column:
    return F.element_at(F.lit(names), (_byte(i) * 256 + _byte(i + 1)) % len(names) + 1)


def _given() -> Column:
    """A given name of the script and gender; after three attempts with a second one."""
    out = F.lit(None).cast("string")
    for script, lists in GIVEN.items():
        for gender, names in lists.items():
            name = _pick(names.split(), F.lit(0))
            second = F.concat(name, F.lit("-"), _pick(names.split(), F.lit(2)), _syllables(script, F.col("attempt") - 3, False))
            name = F.when(F.col("attempt") < 3, name).otherwise(second)
            out = F.when(F.col("variant") == f"{script} {gender}", name).otherwise(out)
    return out


def _syllables(script: str, n: Column, capital: bool) -> Column:
    # initcap() would also lower the rest, which is lower case anyhow.
    text = F.array_join(
        F.transform(F.sequence(F.lit(1), F.greatest(n, F.lit(1))), lambda i: _pick(SYLLABLES[script], i * 4)), ""
    )
    return F.initcap(text) if capital else F.when(n > 0, text).otherwise("")


def _surname() -> Column:
    """Three syllables of the script, one more with every attempt."""
    out = F.lit(None).cast("string")
    for script in SYLLABLES:
        name = _syllables(script, F.lit(3) + F.col("attempt"), True)
        out = F.when(F.col("variant").startswith(script), name).otherwise(out)
    return out


def with_surrogate(todo: DataFrame) -> DataFrame:
    """``todo`` with ``new``, the replacement of ``canonical`` in the row's ``attempt``, of the row's ``kind``."""
    kind, text = F.col("kind"), F.col("canonical")
    # What stays before and after the part that is drawn.
    before = (
        F.when(kind == "secret", F.regexp_extract(text, f"^({_MARK}?)", 1))
        .when(kind == "iban", F.substring(text, 1, 2))
        .when(kind == "ipv6", F.regexp_extract(text, r"^([0-9a-f]+:)", 1))
        .otherwise("")
    )
    after = F.when(kind == "email", F.regexp_extract(text, r"(\.\p{L}+)$", 1)).otherwise("")
    low = F.when(kind == "phone", 2).otherwise(0)
    split = todo.withColumns({"_before": before, "_after": after})
    length = F.length(text) - F.length("_before") - F.length("_after")
    split = split.withColumn("_value", F.substring(text, F.length("_before") + 1, length))
    drawn = F.when(~kind.isin("ip", "given", "surname"), _letters(F.col("_value"), low))
    # Where the originals leave too few others of their format, a draw grows.
    more = _syllables("Latin", (F.col("attempt") - 9).cast("int"), False)
    new = (
        F.when(kind == "secret", F.concat("_before", "_drawn", more))
        .when(kind == "email", F.concat(more, "_drawn", "_after"))
        .when(kind == "iban", _iban(text, F.col("_drawn")))
        .when(kind == "ssn", F.concat(F.lit("9"), F.substring("_drawn", F.lit(2), F.length(text))))
        .when(kind == "ip", _address(text))
        .when(kind == "ipv6", F.concat("_before", "_drawn"))
        .when(kind == "phone", F.col("_drawn"))
        .when(kind == "card", _card(text, F.col("_drawn")))
        .when(kind == "given", _given())
        .otherwise(_surname())
    )
    return split.withColumn("_drawn", drawn).withColumn("new", new)


def surrogates(found: DataFrame, key: str) -> DataFrame:
    """``kind``, ``variant``, ``canonical`` and ``new`` for every distinct part of mentions.

    A surrogate is drawn from a keyed hash, so it is the same in every document and run.
    It is drawn again while it equals any original of its kind or the surrogate of
    another original; of several with the same one, the least original keeps it. The
    draws after the first concern collisions alone, and each stores only what is new in
    it. From the eleventh on, secrets and addresses get letters added, as names do
    earlier, so a format with few values ends too.
    """
    same = ["kind", "canonical"]
    group = ["kind", "variant", "canonical"]
    todo = stored(found.select(*group).distinct())
    originals = todo.select("kind", F.col("canonical").alias("new")).distinct()
    done: DataFrame | None = None
    attempt = 0
    while True:
        seed = F.concat_ws("\x1f", F.lit(key), F.col("kind"), F.col("variant"), F.col("canonical"), F.lit(str(attempt)))
        keyed = F.concat(F.sha2(F.concat(seed, F.lit("\x1f1")), 512), F.sha2(F.concat(seed, F.lit("\x1f2")), 512))
        drawn = with_surrogate(todo.withColumns({"attempt": F.lit(attempt), "_bytes": keyed})).select(*group, "new")
        # Written, so that the draw is not made anew for each of its uses.
        drawn = stored(drawn)
        first = drawn.groupBy("kind", "new").agg(F.min(F.struct("canonical", "variant")).alias("_first"))
        free = drawn.join(first, ["kind", "new"]).filter(F.struct("canonical", "variant") == F.col("_first"))
        free = free.join(originals, ["kind", "new"], "left_anti")
        if done is not None:
            free = free.join(done.select("kind", "new"), ["kind", "new"], "left_anti")
        got = stored(free.select(*group, "new"))
        done = got if done is None else done.unionByName(got)
        left = todo.join(done, [*same, "variant"], "left_anti")
        if not left.limit(1).count():
            return done
        todo, attempt = stored(left.select(*group)), attempt + 1


def _rendered(mention: Column, digits: Column) -> Column:
    """``mention`` with its last digits replaced by ``digits``, in its own format."""
    kept = F.length(_digits(mention)) - F.length(digits)

    def one(c: Column, i: Column) -> Column:
        before = F.length(_digits(F.substring(mention, F.lit(1), i))) - kept
        return F.when(c.rlike("[0-9]") & (before >= 0), F.substring(digits, before + 1, F.lit(1))).otherwise(c)

    return F.array_join(F.transform(F.split(mention, ""), one), "")


def _spaced(mention: Column, text: Column) -> Column:
    """``text``, which has no blanks, with blanks where ``mention`` has them."""

    def one(c: Column, i: Column) -> Column:
        before = F.length(F.replace(F.substring(mention, F.lit(1), i), F.lit(" ")))
        return F.when(c == " ", c).otherwise(F.substring(text, before + 1, F.lit(1)))

    return F.array_join(F.transform(F.split(mention, ""), one), "")


def replacements(found: DataFrame, key: str) -> DataFrame:
    """``mention``, ``new`` and ``names`` for every distinct mention of ``found``, which has ``kind`` too.

    ``names`` has a person's names (``name`` in lower case, ``new``); it is null for other kinds.
    """
    found = stored(parts(found))
    drawn = found.join(surrogates(found, key), ["kind", "variant", "canonical"])
    # A mention has one part, or those of a name of four words at most.
    by_mention = drawn.groupBy("mention").agg(
        F.min("kind").alias("kind"),
        F.sort_array(F.collect_list(F.struct("place", "new", F.col("canonical").alias("name")))).alias("parts"),
    )
    news = F.col("parts.new")
    mention, kind = F.col("mention"), F.col("kind")
    person = kind.isin("given", "surname")
    title = F.regexp_extract(mention, rf"^({_TITLE}\.? )", 1)
    called = F.zip_with(news, _names_of(mention), _like)
    names = F.transform("parts", lambda x: F.struct(x["name"].alias("name"), x["new"].alias("new")))
    front = F.regexp_extract(mention, f"^({_FRONT}?)", 1)
    back = F.regexp_extract(mention, f"({_BACK})$", 1)
    new = (
        F.when(person, F.concat(title, F.array_join(called, " ")))
        .when(kind.isin("phone", "card"), _rendered(mention, F.get(news, 0)))
        .when(kind == "iban", _spaced(mention, F.get(news, 0)))
        .when(kind == "secret", F.concat(front, F.get(news, 0), back))
        .otherwise(F.get(news, 0))
    )
    return by_mention.select("mention", new.alias("new"), F.when(person, names).alias("names"))


def _renamed(word: Column) -> Column:
    """The surrogate of a name that the text has with a title, of the first if several; else ``word``.

    Of a hyphenated word that is no such name, each part is looked up.
    """
    place = lambda x: (F.array_position("_names", F.lower(x)) - 1).cast("int")
    known = lambda x: F.coalesce(_like(F.get(F.col("_named"), place(x)), x), x)
    return F.when(known(word) != word, known(word)).otherwise(F.array_join(F.transform(F.split(word, "-"), known), "-"))


def replace_private(docs: DataFrame, key: str) -> DataFrame:
    """``docs`` with surrogates in ``text`` and ``n_replaced``, how many stand in it.

    Replaced are credentials (after key words, in JSON too, with known beginnings, bearer
    tokens, private keys), e-mail addresses, account and card numbers, IP addresses, phone
    numbers, titled names, and names that begin with one of ``KNOWN`` or ``GIVEN``; these
    names also where they stand alone in the same text, before or after, each word counted
    by itself. A replacement has its original's kind and format; check digits of cards and
    accounts stay right; private networks stay private; names keep script, gender and
    capitals. Equal originals are replaced alike in all documents, different ones
    differently. Other text stays; names without a title and with an unlisted given name
    are not found.

    Null texts stay null with 0, empty ones empty. Repeated rows are documents of their own.
    Texts of any length are searched whole, once. ``n_replaced`` replaces a column of that name.
    """
    docs = docs.drop("n_replaced")
    keyed = docs.withColumn("_key", F.md5(F.coalesce("text", F.lit(""))))
    inside = stored(occurrences(keyed))
    pairs = stored(replacements(stored(kinds(inside.select("mention").distinct())), key))
    news = stored(
        inside.join(sized(pairs).frame, "mention")
        .groupBy(F.col("_key").alias("_of"))
        .agg(F.sort_array(F.collect_list(F.struct("place", "new", "names"))).alias("_new"))
        .withColumn("_names", F.flatten(F.filter("_new.names", lambda x: x.isNotNull())))
        .select(
            "_of",
            F.col("_new.new").alias("_new"),
            F.when(F.size("_names") > 0, F.col("_names.name")).alias("_names"),
            F.col("_names.new").alias("_named"),
        )
    )
    outside = F.split("text", ANY)
    words = lambda part: F.regexp_extract_all(part, F.lit(_WORD), F.lit(0))

    def untitled(part: Column) -> Column:
        # One more gap than words.
        news = F.transform(words(part), _renamed)
        joined = F.zip_with(F.split(part, _WORD), news, lambda gap, new: F.concat(gap, F.coalesce(new, F.lit(""))))
        return F.when(F.col("_names").isNull(), part).otherwise(F.array_join(joined, ""))

    between = F.transform(
        outside, lambda part, i: F.concat(untitled(part), F.coalesce(F.get(F.col("_new"), i), F.lit("")))
    )
    renamed = F.filter(F.flatten(F.transform(outside, words)), lambda word: _renamed(word) != word)
    n_untitled = F.when(F.col("_names").isNull(), 0).otherwise(F.size(renamed))
    return (
        keyed.join(sized(news).frame, F.col("_key") == F.col("_of"), "left")
        .withColumn("n_replaced", (F.coalesce(F.size("_new"), F.lit(0)) + n_untitled).cast("long"))
        .withColumn("text", F.when(F.col("_new").isNull(), F.col("text")).otherwise(F.array_join(between, "")))
        .select(*docs.columns, "n_replaced")
    )


def op8_private_data(spark, sf_dir) -> DataFrame:
    """Every document with surrogates instead of personal data."""
    found = replace_private(read(spark, sf_dir, "documents"), key="registered query")
    return found.select("doc_id", "text", "n_replaced")
