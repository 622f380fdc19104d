"""PII surrogates: detected entities give way to keyed replacements of the same type, gender, script and format.

Replacements come from keyed permutations, so that distinct entities stay distinct and equal ones equal at any scale,
without a table of entities: letters and digits move within their own class (script, case, vowels and consonants of
names) by an amount that a keyed hash takes from the rest of the entity, once from the left and once from the right,
listed names move along a keyed cycle of the names of their gender and script, and numbers keep their check digits and
ranges. A person found once in a text is replaced wherever a word of the name stands in it. All is checked over the
whole corpus afterwards, and should two entities of a kind share a replacement, or one be its own, they are keyed anew.

Names are found after a title (of the listed languages, also in scripts without case), as a listed given name and a
family name, as two capitalised words after a cue ("Contact", "Name:") or before an e-mail address, and in Chinese,
Japanese and Korean before a form of address. Other names stay.
Only JVM expressions run.
"""

from __future__ import annotations

import hashlib
import hmac
from collections.abc import Callable
from functools import reduce
from itertools import chain

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strataframe.llm.common import ascii_lower, materialize

#: Listed given names by script and gender, and family names by script.
GIVEN = {
    ("latin", "female"): """Mary Patricia Jennifer Linda Elizabeth Barbara Susan Jessica Karen Sarah Emma Olivia Sophie Camille Chloé Amélie Élodie Ingrid Heike Ursula Greta Lucía Carmen
    Paula Elena Marta Beatriz Hannah Julia Maria Anna Laura Sofia Isabella Giulia Francesca Chiara Martina Alice Charlotte Emily Grace Lucy Rachel Rebecca Victoria Nicole Michelle Amanda Melissa
    Stephanie Katherine Margaret Helen Nancy Sandra Ashley Donna Carol Ruth Sharon Amy Angela Brenda Nicola Claire Isabelle Nathalie Sylvie Monika Petra Sabine Claudia Katrin Anja Lena Fatima
    Aisha Leila Mei Priya Ananya Yuki Sakura""".split(),
    ("latin", "male"): """James Robert John Michael David William Richard Thomas Charles Daniel Matthew Anthony Pierre François Étienne Julien Olivier Klaus Jürgen Stefan Wolfgang Dieter José
    Carlos Miguel Javier Álvaro Peter Paul Jack Harry George Oliver Henry Edward Andrew Joseph Christopher Steven Kevin Brian Ronald Timothy Jason Jeffrey Ryan Jacob Nicholas Eric Jonathan Stephen
    Larry Justin Scott Brandon Benjamin Samuel Gregory Patrick Alexander Raymond Marco Luca Giuseppe Antonio Francesco Alessandro Lorenzo Matteo Jean Jacques Philippe Laurent Hans Andreas Markus
    Tobias Sebastian Felix Lukas Ahmed Mohammed Omar Hassan Wei Raj Arjun Kenji Hiroshi""".split(),
    ("cyrillic", "female"): "Анна Мария Елена Ольга Наталья Татьяна Ирина Светлана Екатерина Юлия Дарья".split(),
    ("cyrillic", "male"): "Иван Сергей Дмитрий Алексей Николай Михаил Андрей Владимир Павел Борис Юрий".split(),
    ("greek", "female"): "Ελένη Κατερίνα Σοφία Γεωργία Αγγελική".split(),
    ("greek", "male"): "Γιώργος Δημήτρης Κώστας Νίκος Παναγιώτης".split(),
}
FAMILY = {
    "latin": """Smith Johnson Brown Miller Davis Wilson Anderson Taylor Moore Jackson Martin Thompson White Müller Schmidt Schneider Fischer Weber Wagner Becker Dubois Durand Lefèvre Moreau
    García Martínez López Sánchez Pérez Gómez Garcia Martinez Lopez Sanchez Perez Gomez Gonzalez Rodriguez Fernandez Hernandez Ramirez Torres Rivera Flores Diaz Reyes Cruz Ortiz Clark Lewis Walker
    Hall Young Allen Wright Hill Green Adams Baker Nelson Carter Mitchell Roberts Turner Phillips Campbell Parker Evans Edwards Collins Stewart Morris Murphy Cook Rogers Morgan Cooper Peterson Reed
    Bailey Kelly Howard Richardson Rossi Russo Ferrari Bianchi Romano Colombo Ricci Marino Bernard Petit Robinson Leroy Roux Fournier Hoffmann Koch Bauer Richter Klein Wolf Neumann Schwarz
    Zimmermann Krüger Hofmann Hartmann Lange""".split(),
    "cyrillic masculine": "Иванов Петров Сидоров Смирнов Кузнецов Попов Соколов".split(),
    "cyrillic feminine": "Иванова Петрова Сидорова Смирнова Кузнецова Попова Соколова".split(),
    "han": list("王李张刘陈杨赵黄周吴徐孙胡朱高林何郭马罗梁宋郑谢韩唐冯于董萧程曹袁邓许傅沈曾彭吕張劉陳楊趙黃吳孫馬羅鄭謝韓馮蕭鄧許呂"),
    "hangul": list("김이박최정강조윤장임한오서신권황안송류전홍"),
}
#: Forms of address before a name, and after one in scripts that run words together; words that a name follows.
TITLES = "Mr Mrs Ms Miss Dr Prof Herr Frau Monsieur Madame Mme Mlle Señor Señora Sra Sr Signor Signora Г-н Г-жа Господин Госпожа Κύριος Κυρία السيد السيدة الدكتور الدكتورة الأستاذ الأستاذة מר גברת श्री श्रीमती".split()
AFTER_HAN, AFTER_JAPANESE, AFTER_HANGUL = "先生 女士 小姐 博士 教授 老师 老師".split(), "さん 様 氏".split(), "씨 님 선생님 교수님 박사님".split()
CUES = "Contact contact Contacter Contacto Kontakt Dear Liebe Lieber Cher Chère Estimado Estimada Attn Attention Regards Sincerely Name name Nom Nombre Author Patient Customer Employee Manager Signed Ansprechpartner named emailed".split()
CUE_PHRASES = ["name is", "I am", "I'm", "ich heiße", "je m'appelle", "me llamo", "mi chiamo"]
#: First and last code points of the classes within which a character moves.
RANGES = [(0x30, 0x39), (0x61, 0x7A), (0xE0, 0xF6), (0xF8, 0xFF), (0x3B1, 0x3C9), (0x430, 0x44F), (0x5D0, 0x5EA), (0x627, 0x63A), (0x641, 0x64A), (0x905, 0x939), (0x3041, 0x3096), (0x30A1, 0x30FA), (0x4E00, 0x9FA5), (0xAC00, 0xD7A3)]
#: Classes narrower than the ranges: none, hexadecimal digits, vowels and consonants of names.
ALPHABETS = ((), ("0123456789abcdef",), ("aeiou", "bcdfghklmnprst", "jqvwxyz", "áàâäéèêëíìîïóòôöúùûü", "çñ", "аеиоуыэюя", "бвгджзйклмнпрстфхцчшщ"))

#: A capitalised word of a name, without a possessive s.
_WORD = r"(?:\p{Lu}\p{L}+|\p{Lu}(?=['’]\p{L}{2}))(?:[\-'’](?!s(?!\p{L}))\p{L}+)*+"
_PLAIN = r"(?:\p{Lu}['’])?\p{Lu}\p{Ll}+(?:[\-'’](?!s(?!\p{L}))\p{L}+)*+"
_GIVEN = "|".join(sorted((n for names in GIVEN.values() for n in names), key=lambda n: (-len(n), n)))
_CUE = rf"(?<=(?<![\p{{L}}])(?:{'|'.join(CUES + CUE_PHRASES)})[ :,\n]{{1,2}})"
_NAME_END = r"(?![\p{L}\p{N}])"
_SECRET_LABEL = r"(?i:passwords?|passwd|pwd|secret|api[_\-]?key|access[_\-]?key|token)\s{0,3}[=:]\s{0,3}[\"'“]?"
#: What each kind looks like, in the order of precedence; every match starts at the start of a word or number.
PATTERNS = {
    "EMAIL": r"[\p{L}\p{N}_][\p{L}\p{N}._%+\-]*+@(?:[\p{L}\p{N}\-]+\.)+\p{L}{2,}+",
    "SECRET": _SECRET_LABEL + r"[^\s\"'”,;]{6,}+",
    "KEY": r"(?:AKIA[0-9A-Z]{16}|gh[pousr]_[A-Za-z0-9]{36}|sk-[A-Za-z0-9]{20,}+|[0-9a-f]{32,}+|[0-9A-F]{32,}+)(?![\p{L}\p{N}])",
    "IBAN": r"[A-Z]{2}[0-9]{2}(?:[A-Z0-9]{11,30}+|(?: [A-Z0-9]{4}){3,7}(?: [A-Z0-9]{1,3})?)(?![\p{L}\p{N}])",
    "IPV6": r"(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}(?![\p{L}\p{N}:])",
    "MAC": r"(?:[0-9A-Fa-f]{2}[:\-]){5}[0-9A-Fa-f]{2}(?![\p{L}\p{N}:])",
    "IP": r"(?<![0-9]\.)(?:(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[1-9]?[0-9])\.){3}(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[1-9]?[0-9])(?!\.?[0-9])(?![\p{L}_])",
    "CARD": r"(?:[0-9]{13,19}+|[0-9]{4}(?:[ \-][0-9]{4}){3}|3[47][0-9]{2}[ \-][0-9]{6}[ \-][0-9]{5})(?![\p{L}\p{N}])",
    "SSN": r"[0-9]{3}-[0-9]{2}-[0-9]{4}(?![\p{L}\p{N}])",
    "PHONE": r"(?:\+[0-9]{1,3}[ .\-]?(?:\([0-9]{1,4}\)[ .\-]?)?[0-9]{1,4}(?:[ .\-]?[0-9]{2,4}){1,4}|\([0-9]{3}\)[ .\-]?[0-9]{3}[ .\-]?[0-9]{4}|[0-9]{3}([ .\-])[0-9]{3}\1[0-9]{4}|0[0-9]{2,4}[ /][0-9]{3,4}[ \-]?[0-9]{2,4}|[2-9][0-9]{2}-[0-9]{4})(?![\p{L}\p{N}])",
    "NAME": rf"(?=[\p{{Lu}}\p{{Lo}}])(?:(?:{'|'.join(TITLES)})\.? (?:{_WORD}(?: {_WORD}){{0,2}}|\p{{Lo}}[\p{{L}}\p{{M}}]+)|(?=\p{{L}}[\p{{L}}'’\-]*+ \p{{Lu}})(?:(?:{_GIVEN}) {_WORD}|{_CUE}{_PLAIN} {_PLAIN}|{_PLAIN} {_PLAIN}(?=[ ,]{{0,2}}[<(]?[\p{{L}}\p{{N}}._%+\-]{{1,64}}@))){_NAME_END}",
}
START = r"(?<![\p{L}\p{N}_])"
_UNSPACED = rf"(?=[\u3400-\uD7A3])(?:[{''.join(FAMILY['han'])}]\p{{IsHan}}{{1,2}}(?={'|'.join(AFTER_HAN)})|(?<!\p{{IsHan}})\p{{IsHan}}{{2,4}}(?= ?(?:{'|'.join(AFTER_JAPANESE)}))|[{''.join(FAMILY['hangul'])}]\p{{IsHangul}}{{2}}(?= ?(?:{'|'.join(AFTER_HANGUL)})))"
ANY = START + "(?:" + "|".join(PATTERNS.values()) + ")|" + _UNSPACED
#: The same, and all capitalised words besides, for texts in which a person was found.
ANY_OR_WORD = ANY + "|" + START + _WORD + _NAME_END
_KEY_PREFIX = "^(?:AKIA|gh[pousr]_|sk-)"
_HEX = "^(?:[0-9a-f]{16,}|[0-9A-F]{16,})$"
_TITLE = rf"^(?:{'|'.join(TITLES)})\.? "
RETRIES = 16  # new keys for an entity that is its own replacement; what has nothing that could move stays


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """use(value), with value evaluated once."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _chars(s: Column) -> Column:
    return F.regexp_extract_all(s, F.lit("(?s)."), F.lit(0))


def _amount(s: Column) -> Column:
    """A keyed amount; s holds the key."""
    return F.shiftrightunsigned(F.xxhash64(F.sha2(s.cast("binary"), 256)), 8)


def _moved(c: Column, by: Column, alphabet: Column) -> Column:
    """Character c moved within the first of the ALPHABETS at place alphabet that has it, or else within its range."""
    code_range = lambda code: reduce(lambda out, r: F.when(code.between(*r), F.struct(F.lit(r[0]).alias("low"), F.lit(r[1] - r[0] + 1).alias("size"))).otherwise(out), RANGES, F.lit(None).cast("struct<low:int,size:int>"))
    char = lambda n: F.decode(F.unhex(F.lpad(F.hex(n), 4, "0")), "UTF-16BE")
    by_range = let(F.ascii(c), lambda code: let(code_range(code), lambda r: F.when(r.isNull(), c).otherwise(char(r["low"] + F.pmod(code - r["low"] + by, r["size"])))))
    letters = F.get(F.filter(F.get(F.array(*[F.array(*[F.lit(x) for x in a]).cast("array<string>") for a in ALPHABETS]), alphabet), lambda a: F.instr(a, c) > 0), F.lit(0))
    turned = lambda a: F.substr(a, (F.pmod(F.instr(a, c) - 1 + by, F.length(a)) + 1).cast("int"), F.lit(1))
    return let(letters, lambda a: F.when(a.isNotNull(), turned(a)).otherwise(by_range))


def _pass(s: Column, tweak: Column, alphabet: Column) -> Column:
    """Moves each character by a keyed hash of the moved ones before it: can be undone, so a permutation.

    The hash runs along, so that a character costs the same in entities of any length.
    """
    first = F.struct(F.lit("").alias("s"), F.sha2(tweak.cast("binary"), 256).alias("h"))
    next_hash = lambda h, c: F.sha2(F.concat(h, c).cast("binary"), 256)
    move = lambda done, c: let(_moved(c, F.shiftrightunsigned(F.xxhash64(done["h"]), 8), alphabet), lambda m: F.struct(F.concat(done["s"], m).alias("s"), next_hash(done["h"], m).alias("h")))
    return F.aggregate(_chars(s), first, move, lambda done: done["s"])


def permuted(s: Column, tweak: Column, alphabet: Column) -> Column:
    """s with every letter and digit moved within its class: one keyed permutation for all strings of a format."""
    # from the left, then from the right: one expression, run over the two directions
    turn = lambda done, way: F.reverse(_pass(done, F.concat(tweak, way), alphabet))
    return let(s, lambda s: F.aggregate(F.array(F.lit("|>|"), F.lit("|<|")), s, turn))


def _number(v: Column, low: Column | int, size: Column | int) -> Column:
    """A number that moves within size values from low on."""
    as_long = lambda x: F.lit(x).cast("long") if isinstance(x, int) else x.cast("long")
    return F.struct(v.cast("long").alias("v"), as_long(low).alias("low"), as_long(size).alias("size"))


def _shifted(numbers: Column, tweak: Column) -> Column:
    """Numbers moved within their ranges, each by a keyed hash of the moved ones before it, from the left and the right."""
    values = lambda done: F.array_join(F.transform(done, lambda n: n["v"].cast("string")), ".")
    by = lambda done, way: _amount(F.concat(tweak, way, values(done)))
    moved = lambda n, by: _number(n["low"] + F.pmod(n["v"] - n["low"] + by, n["size"]), n["low"], n["size"])
    turn = lambda all_, way: F.reverse(F.aggregate(all_, F.array().cast("array<struct<v:bigint,low:bigint,size:bigint>>"), lambda done, n: F.concat(done, F.array(moved(n, by(done, way))))))
    return F.aggregate(F.array(F.lit("|>|"), F.lit("|<|")), numbers, turn)


def _special(a: Column, b: Column) -> Column:
    """Whether an address that starts with a.b is private, local, multicast or reserved."""
    return a.isin(0, 10, 127) | (a >= 224) | ((a == 169) & (b == 254)) | ((a == 192) & (b == 168)) | ((a == 172) & b.between(16, 31))


def _address(raw: Column, tweak: Column) -> Column:
    """An IPv4 address of the same kind: public, or in the same private, local or reserved range."""

    def within(o: Column) -> Column:
        a, b = o[0], o[1]
        rest = [_number(o[i], 0, 256) for i in (2, 3)]
        whole = _number(b, 0, 256)
        one = F.when(a.isin(0, 10, 127), F.array(_number(a, a, 1), whole, *rest))
        two = one.when(a >= 224, F.array(_number(a, 224, 32), whole, *rest)).when((a == 172) & b.between(16, 31), F.array(_number(a, a, 1), _number(b, 16, 16), *rest))
        return two.when(_special(a, b), F.array(_number(a, a, 1), _number(b, b, 1), *rest)).otherwise(F.array(_number(a, 1, 223), whole, *rest))

    def walked(o: Column) -> Column:
        # a public address that becomes a special one moves on
        step = lambda now, i: F.when((i == 0) | (~_special(o[0], o[1]) & _special(now[0]["v"], now[1]["v"])), _shifted(now, tweak)).otherwise(now)
        return F.aggregate(F.sequence(F.lit(0), F.lit(7)), within(o), step)

    octets = F.transform(F.split(raw, r"\."), lambda o: o.cast("int"))
    return let(octets, lambda o: F.array_join(F.transform(walked(o), lambda n: n["v"].cast("string")), "."))


def _social_security(digits: Column, tweak: Column) -> Column:
    """Nine digits of the same kind: an area, group and serial that are given out, or are not, stay so."""
    part = lambda a, n: F.substr(digits, F.lit(a), F.lit(n)).cast("int")
    area, given = part(1, 3), lambda a: a.between(1, 899) & (a != 666)
    first = F.when(given(area), _number(area - (area > 666).cast("int"), 1, 898)).when(area >= 900, _number(area, 900, 100)).otherwise(_number(area, area, 1))
    some = lambda v, size: F.when(v > 0, _number(v, 1, size)).otherwise(_number(v, 0, 1))
    moved = _shifted(F.array(first, some(part(4, 2), 99), some(part(6, 4), 9999)), tweak)
    back = lambda v: F.when(given(area) & (v >= 666), v + 1).otherwise(v)
    return let(moved, lambda m: F.concat(F.lpad(back(m[0]["v"]).cast("string"), 3, "0"), F.lpad(m[1]["v"].cast("string"), 2, "0"), F.lpad(m[2]["v"].cast("string"), 4, "0")))


def _mod97(s: Column) -> Column:
    """The remainder by 97 of a string of digits and capital letters, letters as 10 to 35."""
    step = lambda acc, c: F.when(c.between("0", "9"), (acc * 10 + c.cast("int")) % 97).otherwise((acc * 100 + F.ascii(c) - 55) % 97)
    return F.aggregate(_chars(s), F.lit(0), step)


def _iban(raw: Column, account: Column) -> Column:
    """The IBAN of an account in raw's country, whose check digits are as right or as wrong as raw's."""
    plain = F.regexp_replace(raw, " ", "")
    country = F.substr(plain, F.lit(1), F.lit(2))
    check = lambda account: 98 - _mod97(F.concat(account, country, F.lit("00")))
    gap = F.substr(plain, F.lit(3), F.lit(2)).cast("int") - check(F.substr(plain, F.lit(5), F.length(plain)))
    right = F.lpad((F.pmod(check(account) + gap - 2, F.lit(97)) + 2).cast("string"), 2, "0")
    return F.concat(country, spread(F.substr(raw, F.lit(3), F.length(raw)), F.concat(right, account)))


def _cased(out: Column, like: Column) -> Column:
    """out, upper case where like is."""
    zipped = lambda out: F.zip_with(_chars(out), _chars(like), lambda o, c: F.when((F.lower(c) != c) & (F.length(F.upper(o)) == 1), F.upper(o)).otherwise(o))
    return let(out, lambda o: F.when(like == F.lower(like), o).otherwise(F.array_join(zipped(o), "")))


def _filled(raw: Column, digits: Column) -> Column:
    """raw with its digits replaced in order."""
    put = lambda s, c: F.when(c.between("0", "9"), F.struct(F.concat(s["s"], F.substr(digits, s["k"], F.lit(1))).alias("s"), (s["k"] + 1).alias("k"))).otherwise(F.struct(F.concat(s["s"], c).alias("s"), s["k"].alias("k")))
    return F.aggregate(_chars(raw), F.struct(F.lit("").alias("s"), F.lit(1).alias("k")), put, lambda s: s["s"])


def _digits(s: Column) -> Column:
    return F.regexp_replace(s, "[^0-9]", "")


def _luhn(payload: Column) -> Column:
    """The check digit of a string of digits."""
    doubled = lambda d: F.when(d > 4, 2 * d - 9).otherwise(2 * d)
    total = F.aggregate(F.transform(_chars(F.reverse(payload)), lambda c, i: F.when(i % 2 == 0, doubled(c.cast("int"))).otherwise(c.cast("int"))), F.lit(0), lambda a, d: a + d)
    return F.pmod(-total, F.lit(10))


def cycle(names: list[str], key: str, kind: str) -> dict[str, str]:
    """Each name's successor in the keyed order: no name keeps its place."""
    order = sorted(names, key=lambda n: hmac.new(key.encode(), f"{kind}|{n}".encode(), hashlib.sha256).digest())
    return {n.lower(): order[(i + 1) % len(order)].lower() for i, n in enumerate(order)}


def kind_of(raw: Column) -> Column:
    """The first kind whose pattern the whole entity matches; names, which may need their context for that, come last."""
    out = F.lit("NAME")
    for kind, pattern in reversed(PATTERNS.items()):
        out = F.when(raw.rlike(rf"^(?:{pattern})$"), F.lit(kind)).otherwise(out)
    return out


def normal_form(kind: Column, raw: Column) -> Column:
    """What equal entities of a kind have in common, however they are written."""
    by_kind = {
        "SECRET": F.regexp_extract(raw, rf"(?s)^{_SECRET_LABEL}(.*)$", 1),
        "KEY": raw,
        "IBAN": F.lower(F.regexp_replace(raw, " ", "")),
        "MAC": F.lower(F.regexp_replace(raw, "-", ":")),
        "CARD": _digits(raw),
        "SSN": _digits(raw),
        "PHONE": _digits(raw),
        "NAME": F.lower(F.regexp_replace(raw, _TITLE, "")),
    }
    out = F.lower(raw)
    for k, form in by_kind.items():
        out = F.when(kind == k, form).otherwise(out)
    return out


def listed_names(key: str) -> dict[str, str]:
    """The successor of each listed given and family name; a name that is listed twice has its first place."""
    out: dict[str, str] = {}
    for k, names in {**{"/".join(k): names for k, names in GIVEN.items()}, **FAMILY}.items():
        out |= cycle([n for n in dict.fromkeys(names) if n.lower() not in out], key, k)
    return out


def _part(s: Column, tweak: Column, alphabet: Column | int = 0) -> Column:
    return F.struct(s.alias("s"), tweak.alias("t"), (F.lit(alphabet) if isinstance(alphabet, int) else alphabet).alias("a"))


def _name_words(raw: Column) -> Column:
    """The words of a name after its title; of names written without spaces, the first character and the others."""
    return F.split(F.regexp_replace(raw, _TITLE, ""), r" |(?<=^[\p{IsHan}\p{IsHangul}])")


def _ending(word: Column) -> Column:
    """The ending of a name that tells its gender."""
    return F.regexp_extract(word, "(?<=\\p{L}\\p{L})(ова|ева|ина|ская|цкая|ов|ев|ин|ский|цкий|a|o)$", 1)


def _parts(kind: Column, raw: Column) -> Column:
    """What of an entity is moved: array of (string, tweak, alphabet)."""
    low, digits = F.lower(raw), _digits(raw)
    domain = F.substring_index(low, "@", -1)
    name = F.regexp_replace(domain, r"\.[^.]*$", "")
    secret = F.regexp_extract(raw, rf"(?s)^{_SECRET_LABEL}(.*)$", 1)
    key = F.regexp_replace(raw, _KEY_PREFIX, "")
    # values in which upper and lower case differ are other values: what is upper case goes into the tweak
    value = lambda v: _part(F.lower(v), F.when(v.rlike(_HEX), "").otherwise(F.regexp_replace(v, r"[^\p{Lu}]", "~")), F.when(v.rlike(_HEX), 1).otherwise(0))
    none = F.lit("")
    words = F.transform(F.transform(_name_words(raw), F.lower), lambda w: let(_ending(w), lambda e: _part(F.substr(w, F.lit(1), F.length(w) - F.length(e)), e, 2)))
    by_kind = {
        "EMAIL": F.array(_part(F.substring_index(low, "@", 1), F.lit("local")), _part(name, F.lit("domain"))),
        "SECRET": F.array(value(secret)),
        "KEY": F.array(value(key)),
        "IBAN": F.array(_part(F.substr(F.lower(F.regexp_replace(raw, " ", "")), F.lit(5), F.length(raw)), F.substr(raw, F.lit(1), F.lit(2)))),
        "IPV6": F.array(_part(low, none, 1)),
        "MAC": F.array(_part(F.regexp_replace(low, "-", ":"), none, 1)),
        "CARD": F.array(_part(F.substr(digits, F.lit(1), F.length(digits) - 1), none)),
        "PHONE": F.array(_part(F.substr(digits, _kept(digits) + 1, F.lit(10)), none)),
        "NAME": words,
    }
    out = F.array().cast("array<struct<s:string,t:string,a:int>>")
    for k, form in by_kind.items():
        out = F.when(kind == k, form).otherwise(out)
    return out


def _kept(digits: Column) -> Column:
    """Leading digits of a phone number that stay: the country's."""
    return F.greatest(F.length(digits) - 10, F.lit(0))


def surrogate(kind: Column, raw: Column, key: str, attempt: Column) -> Column:
    """The replacement of an entity; attempt tells apart entities whose replacements clashed."""
    tweak = F.concat_ws("|", F.lit(key), attempt.cast("string"), kind)
    listed = listed_names(key)
    known = F.create_map(*[F.lit(x) for x in chain.from_iterable(listed.items())])

    def moved(p: Column) -> Column:
        """A part moved; a name that would become a listed one moves on."""
        once = lambda s: permuted(s, F.concat(tweak, F.lit("|"), p["t"]), p["a"])
        step = lambda s, i: F.when((i == 0) | ((p["a"] == 2) & F.element_at(known, F.concat(s, p["t"])).isNotNull()), once(s)).otherwise(s)
        return F.aggregate(F.sequence(F.lit(0), F.lit(4)), p["s"], step)

    def card(p: Column) -> Column:
        payload = lambda d: F.substr(d, F.lit(1), F.length(d) - 1)
        gap = lambda d: F.pmod(F.substr(d, F.length(d), F.lit(1)).cast("int") - _luhn(payload(d)), F.lit(10))
        return F.concat(p, F.pmod(_luhn(p) + gap(_digits(raw)), F.lit(10)).cast("string"))

    def name(m: Column) -> Column:
        """Word by word: listed names along their cycle, others moved, past listed ones."""
        cased = lambda out, w: F.when((F.length(w) > 1) & (w == F.upper(w)), F.upper(out)).otherwise(F.concat(F.upper(F.substr(out, F.lit(1), F.lit(1))), F.substr(out, F.lit(2), F.length(out))))
        word = lambda w, s: let(F.coalesce(F.element_at(known, F.lower(w)), F.concat(s, _ending(F.lower(w)))), lambda o: cased(o, w))
        joined = lambda ws: F.when(raw.rlike(r"^[\p{IsHan}\p{IsHangul}]"), F.array_join(ws, "")).otherwise(F.array_join(ws, " "))
        return F.concat(F.regexp_extract(raw, _TITLE, 0), let(F.zip_with(_name_words(raw), m, word), joined))

    def put_together(m: Column) -> Column:
        one = F.get(m, F.lit(0))
        label = lambda v: F.substr(raw, F.lit(1), F.length(raw) - F.length(v))
        of_value = lambda v: F.concat(label(v), _cased(one, v))
        digits = F.when(kind == "CARD", card(one)).when(kind == "SSN", _social_security(_digits(raw), tweak)).when(kind == "PHONE", F.concat(F.substr(_digits(raw), F.lit(1), _kept(_digits(raw))), one)).otherwise(one)
        by_kind = {
            "EMAIL": _cased(F.concat(one, F.lit("@"), F.get(m, F.lit(1)), F.regexp_extract(raw, r"\.[^.]*$", 0)), raw),
            "SECRET": let(F.regexp_extract(raw, rf"(?s)^{_SECRET_LABEL}(.*)$", 1), of_value),
            "KEY": let(F.regexp_replace(raw, _KEY_PREFIX, ""), of_value),
            "IBAN": _iban(raw, F.upper(one)),
            "IPV6": _cased(one, raw),
            "MAC": _cased(F.when(raw.contains("-"), F.regexp_replace(one, ":", "-")).otherwise(one), raw),
            "IP": _address(raw, tweak),
            "NAME": name(m),
        }
        out = let(digits, lambda d: _filled(raw, d))
        for k, form in by_kind.items():
            out = F.when(kind == k, form).otherwise(out)
        return out

    return let(F.transform(_parts(kind, raw), moved), put_together)


def spread(like: Column, chars: Column) -> Column:
    """chars with spaces where like has them."""
    put = lambda s, c: F.when(c != " ", F.struct(F.concat(s["s"], F.substr(chars, s["k"], F.lit(1))).alias("s"), (s["k"] + 1).alias("k"))).otherwise(F.struct(F.concat(s["s"], c).alias("s"), s["k"].alias("k")))
    return F.aggregate(_chars(like), F.struct(F.lit("").alias("s"), F.lit(1).alias("k")), put, lambda s: s["s"])


def _replaced(docs: DataFrame, text_col: str, key: str, attempts: str | None) -> DataFrame:
    """docs with new texts and __found, the entities (kind, norm, to, to_norm) of each; attempts: a column of map<kind|norm, int>."""
    text, none = F.col(text_col), F.array().cast("array<string>")
    attempt = (lambda k, n: F.coalesce(F.element_at(F.col(attempts), F.concat_ws("|", k, n)), F.lit(0))) if attempts else (lambda k, n: F.lit(0))
    matches = lambda pattern: F.coalesce(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), none)
    names = F.filter("__first", lambda r: r.rlike(r"^[\p{Lu}\p{Lo}]") & (kind_of(r) == "NAME"))
    people = F.array_distinct(F.flatten(F.transform(names, lambda r: F.transform(_name_words(r), F.lower))))
    found = docs.withColumn("__first", matches(ANY)).withColumn("__people", people)
    someone = F.size("__people") > 0
    found = found.withColumn("__raws", F.when(someone, matches(ANY_OR_WORD)).otherwise(F.col("__first")))

    def entity(r: Column) -> Column:
        with_norm = lambda k: let(normal_form(k, r), lambda n: let(surrogate(k, r, key, attempt(k, n)), lambda to: F.struct(k.alias("kind"), n.alias("norm"), to.alias("to"), normal_form(k, to).alias("to_norm"))))
        other = someone & r.rlike(f"^{_WORD}$") & ~F.array_contains("__people", F.lower(r))
        return F.when(other, F.struct(F.lit(None).cast("string").alias("kind"), F.lit("").alias("norm"), r.alias("to"), F.lit("").alias("to_norm"))).otherwise(let(kind_of(r), with_norm))

    found = found.withColumn("__each", F.transform("__raws", entity))
    gaps = F.when(someone, F.split(text, ANY_OR_WORD, -1)).otherwise(F.split(text, ANY, -1))
    joined = F.array_join(F.zip_with(gaps, "__each", lambda g, e: F.concat(g, F.coalesce(e["to"], F.lit("")))), "")
    found = found.withColumn("__found", F.filter("__each", lambda e: e["kind"].isNotNull()))
    return found.withColumn(text_col, F.when(F.size("__found") > 0, joined).otherwise(text)).drop("__first", "__people", "__raws", "__each")


def clashes(found: DataFrame) -> DataFrame:
    """(kind, norm, own): entities to be keyed anew, as they share a replacement with another of their kind, the least of
    which keeps it, or are their own (own)."""
    entities = found.select(F.explode("__found").alias("e")).select("e.kind", "e.to_norm", "e.norm")
    shared = entities.groupBy("kind", "to_norm").agg(F.min("norm").alias("keeps"), F.max("norm").alias("last")).where("keeps <> last OR keeps = to_norm").select("kind", "to_norm", "keeps")
    return entities.join(shared, ["kind", "to_norm"]).where("norm <> keeps OR norm = to_norm").select("kind", "norm", (F.col("norm") == F.col("to_norm")).alias("own")).distinct()


def replace_pii(docs: DataFrame, key: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """docs with the texts' entities replaced, and __found: array of (kind, norm, to, to_norm).

    Texts without entity are returned as they are, nulls as null. All other columns and every row are kept; ids may
    repeat or be null. The same key gives the same replacements in every run and document. Replacements that clash
    anywhere in the corpus, and entities that are their own replacement, are keyed anew, round by round and in the
    documents that hold them alone, until none does; of the latter only those stay that RETRIES keys do not move.
    """
    keyed = docs.withColumn("__row", F.xxhash64(id_col, text_col))
    first = done = materialize(_replaced(keyed, text_col, key, None), "pii", "snappy")
    tried, round_ = None, 0
    while not (again := clashes(done).where(~F.col("own") | F.lit(round_ < RETRIES))).isEmpty():
        bumped = again.select("kind", "norm", F.lit(1).alias("n"))
        total = bumped if tried is None else tried.unionByName(bumped)
        tried = materialize(total.groupBy("kind", "norm").agg(F.sum("n").cast("int").alias("n")), "pii-attempts")
        entities = first.select("__row", F.explode("__found").alias("e")).select("__row", "e.kind", "e.norm").distinct()
        of_row = entities.join(tried, ["kind", "norm"]).groupBy("__row").agg(F.map_from_entries(F.collect_set(F.struct(F.concat_ws("|", "kind", "norm"), "n"))).alias("__attempts"))
        of_row = materialize(of_row, "pii-rows")
        redone = materialize(_replaced(keyed.join(of_row, "__row"), text_col, key, "__attempts").drop("__attempts"), "pii-again", "snappy")
        done = first.join(of_row, "__row", "left_anti").unionByName(redone)
        round_ += 1
    return done.drop("__row")
