"""Format-preserving Feistel pseudonyms for personal data, in SQL functions only.

Validated numbers and dates are permuted within their format under a key: the
same value gets the same pseudonym in every document, different values get
different ones, and whoever has the key can restore the text. A value is seen as
a pair of halves; in turn each half is moved by a keyed hash of the other one,
modulo the number of values that half can take, so that every domain is mapped
onto itself exactly:

* payment card, 13-19 digits with a valid check digit: all but the first digit
  and the check digit, which is made anew; digits that stand beside a card in a usual
  writing (unbroken, 4-4-4-4, 4-6-4, 4-6-5) are not taken as part of it;
* telephone number of the North American plan with +1: its ten digits;
* IPv4 address: all 32 bits; social security number: within the assigned range;
* date (yyyy-mm-dd, mm/dd/yyyy, dd.mm.yyyy) of a day in 1900-2099: within these;
* e-mail address: letters and digits before the @ (at most 64), each within its class.

What fails its validation stays as it is and can never be a pseudonym.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._common import table

ROUNDS = 8

# The formats, by kind.
EMAIL = r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++){1,126}"
PHONE = r"(?<![0-9A-Za-z+])\+1[ .-]?\(?[0-9]{3}\)?[ .-]?[0-9]{3}[ .-]?[0-9]{4}(?![0-9A-Za-z])"
IPV4 = r"(?<![0-9A-Za-z.])(?:[0-9]{1,3}\.){3}[0-9]{1,3}(?![0-9A-Za-z])(?!\.[0-9])"
DATE = (
    r"(?<![0-9A-Za-z])(?:[0-9]{4}-[0-9]{2}-[0-9]{2}|[0-9]{2}/[0-9]{2}/[0-9]{4}|[0-9]{2}\.[0-9]{2}\.[0-9]{4})"
    r"(?:(?![0-9A-Za-z])|(?=[Tt][0-9]{2}:?[0-9]{2}))"
)
SSN = r"(?<![0-9A-Za-z-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9A-Za-z-])"
# A card number as it is usually written, whatever digits stand beside it.
USUAL = (
    r"(?<![0-9A-Za-z])(?:[0-9]{13,19}|[0-9]{4} [0-9]{4} [0-9]{4} [0-9]{4}|[0-9]{4}-[0-9]{4}-[0-9]{4}-[0-9]{4}"
    r"|[0-9]{4} [0-9]{6} [0-9]{4,5}|[0-9]{4}-[0-9]{6}-[0-9]{4,5})(?![0-9A-Za-z])"
)
# Digits joined over spaces and hyphens, none of them a date's, an address's or a social security number's: to their
# end, or else a usual writing, or what stands before one.
_OTHER = f"(?!{DATE}|{SSN}|{IPV4})"
CARD = (
    rf"(?<![0-9A-Za-z])[0-9](?:(?:[ -]{_OTHER})?[0-9]){{12,18}}(?![0-9A-Za-z])(?![ -]{_OTHER}[0-9])"
    rf"|{USUAL}|(?<![0-9A-Za-z])[0-9](?:(?:[ -]{_OTHER}(?!{USUAL}))?[0-9]){{12,18}}(?![0-9A-Za-z])"
)
WALK = 32  # steps at most; each one ends the walk in nine cases of ten
ANY = "|".join((EMAIL, PHONE, IPV4, DATE, SSN, CARD))
# Whole matches, told apart by their shape.
SHAPES = {
    "email": "^[^@]{1,64}@",
    "phone": r"^\+",
    "ip": r"^(?:(?:0|[1-9][0-9]?|1[0-9]{2}|2[0-4][0-9]|25[0-5])(?:\.(?!$)|$)){4}$",
    "iso_date": r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$",
    "us_date": r"^[0-9]{2}/[0-9]{2}/[0-9]{4}$",
    "dot_date": r"^[0-9]{2}\.[0-9]{2}\.[0-9]{4}$",
    "ssn": r"^(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4}$",
    "card": r"^[0-9](?:[ -]?[0-9]){12,18}$",
}
DATE_FORMATS = {"iso_date": "yyyy-MM-dd", "us_date": "MM/dd/yyyy", "dot_date": "dd.MM.yyyy"}
# 73,049 days from 1900-01-01 to 2099-12-31, as 17 * 4297.
DAYS = (17, 4297)


def _quoted(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _is(kind: str, m: str) -> str:
    return f"{m} rlike {_quoted(SHAPES[kind])}"


class _Cipher:
    """SQL text of the permutations under one key."""

    def __init__(self, key: str, inverse: bool):
        self.key = _quoted(key)
        self.rounds = f"sequence({ROUNDS}, 1, -1)" if inverse else f"sequence(1, {ROUNDS})"
        self.sign = "-" if inverse else "+"

    def hashed(self, tag: str, half: str) -> str:
        return f"sha2(concat_ws('|', {self.key}, '{tag}', n, {half}), 256)"

    def moved(self, tag: str, half: str, by: str, size: str) -> str:
        step = f"cast(conv(substr({self.hashed(tag, by)}, 1, 12), 16, 10) as bigint)"
        return f"pmod({half} {self.sign} {step} % {size}, {size})"

    def number(self, tag: str, x: str, left: str, right: str) -> str:
        """x in 0 .. left * right - 1 to a number of that range."""
        start = f"named_struct('l', ({x}) div ({right}), 'r', ({x}) % ({right}))"
        turn = (
            f"(a, n) -> if(n % 2 = 1, named_struct('l', {self.moved(tag, 'a.l', 'a.r', left)}, 'r', a.r), "
            f"named_struct('l', a.l, 'r', {self.moved(tag, 'a.r', 'a.l', right)}))"
        )
        return f"aggregate({self.rounds}, {start}, {turn}, a -> a.l * ({right}) + a.r)"

    def turned(self, half: str, by: str) -> str:
        """Letters and digits of ``half``, each moved within its class."""
        shift = f"cast(conv(substr({self.hashed('email', by)}, 1 + 2 * (i % 32), 2), 16, 10) as int)"

        def within(alphabet: str) -> str:
            n = len(alphabet)
            return f"substr('{alphabet}', 1 + pmod(instr('{alphabet}', c) - 1 {self.sign} {shift}, {n}), 1)"

        classes = ("abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789")
        cases = " ".join(f"when instr('{a}', c) > 0 then {within(a)}" for a in classes)
        return f"array_join(transform(filter(split({half}, ''), c -> c <> ''), (c, i) -> case {cases} else c end), '')"

    def email(self, m: str) -> str:
        local = f"substring_index({m}, '@', 1)"
        middle = f"cast(length({local}) div 2 as int)"
        start = f"named_struct('l', substr({local}, 1, {middle}), 'r', substr({local}, 1 + {middle}))"
        turn = (
            f"(a, n) -> if(n % 2 = 1, named_struct('l', {self.turned('a.l', 'a.r')}, 'r', a.r), "
            f"named_struct('l', a.l, 'r', {self.turned('a.r', 'a.l')}))"
        )
        whole = f"aggregate({self.rounds}, {start}, {turn}, a -> concat(a.l, a.r))"
        return f"concat({whole}, substr({m}, length({local}) + 1))"


def _digits(m: str) -> str:
    return f"regexp_replace({m}, '[^0-9]', '')"


def _refilled(m: str, digits: str) -> str:
    """``m`` with its digits replaced in order, all else kept."""
    nth = f"length({_digits(f'substr({m}, 1, i + 1)')})"
    return f"array_join(transform(split({m}, ''), (c, i) -> if(c rlike '[0-9]', substr({digits}, {nth}, 1), c)), '')"


def _check_digit(body: str) -> str:
    """The digit that makes ``body`` followed by it pass the check of card numbers."""
    digit = f"cast(substr({body}, length({body}) - i, 1) as int)"
    doubled = f"({digit} * 2 - if({digit} > 4, 9, 0))"
    added = f"aggregate(sequence(0, length({body}) - 1), 0, (s, i) -> s + if(i % 2 = 0, {doubled}, {digit}))"
    return f"cast((10 - {added} % 10) % 10 as string)"


def _valid_card(m: str) -> str:
    d = _digits(m)
    return f"({_is('card', m)} and {_check_digit(f'substr({d}, 1, length({d}) - 1)')} = substr({d}, -1))"


def _usual(m: str) -> str:
    return f"regexp_extract({m}, {_quoted(USUAL)}, 0)"


def _card_of(m: str) -> str:
    """What of a match to look at: a valid card in a usual writing within joined digits, or else all of it."""
    return f"if({_is('card', m)} and {_valid_card(_usual(m))}, {_usual(m)}, {m})"


def _valid_date(kind: str, m: str) -> str:
    day = f"try_to_date({m}, '{DATE_FORMATS[kind]}')"
    return f"({_is(kind, m)} and coalesce(year({day}) between 1900 and 2099, false))"


def kind_sql(m: str) -> str:
    """The kind of a match, null where it fails its validation."""
    return (
        f"case when {_is('email', m)} then 'email' when {_is('phone', m)} then 'phone' when {_is('ip', m)} then 'ip' "
        + " ".join(f"when {_valid_date(k, m)} then '{k}'" for k in DATE_FORMATS)
        + f" when {_is('ssn', m)} then 'ssn' when {_valid_card(m)} then 'card' end"
    )


def _pseudonym_sql(v: str, cipher: _Cipher) -> str:
    """The pseudonym of ``v.m``, a match of kind ``v.k``; the match itself where that is null."""
    m = f"{v}.m"
    d = _digits(m)
    phone = f"lpad(cast({cipher.number('phone', f'cast(substr({d}, 2) as bigint)', '100000', '100000')} as string), 10, '0')"
    octets = " + ".join(f"cast(split({m}, '[.]')[{i}] as bigint) * {256 ** (3 - i)}" for i in range(4))
    ip = cipher.number("ip", octets, "65536", "65536")
    address = f"aggregate(array({ip}), '', (s, x) -> concat_ws('.', x div 16777216, x div 65536 % 256, x div 256 % 256, x % 256))"
    dates = " ".join(
        f"when '{k}' then date_format(date_add(date'1900-01-01', cast("
        + cipher.number("date", f"cast(datediff(try_to_date({m}, '{f}'), date'1900-01-01') as bigint)", str(DAYS[0]), str(DAYS[1]))
        + f" as int)), '{f}')"
        for k, f in DATE_FORMATS.items()
    )
    area, group, serial = (f"cast(substr({m}, {a}, {n}) as bigint)" for a, n in ((1, 3), (5, 2), (8, 4)))
    ssn = cipher.number(
        "ssn", f"({area} - 1 - if({area} > 666, 1, 0)) * 989901 + ({group} - 1) * 9999 + {serial} - 1", "898", "989901"
    )
    parted = (
        "concat_ws('-', lpad(cast(x div 989901 + 1 + if(x div 989901 >= 665, 1, 0) as string), 3, '0'), "
        "lpad(cast(x % 989901 div 9999 + 1 as string), 2, '0'), lpad(cast(x % 9999 + 1 as string), 4, '0'))"
    )
    number = f"aggregate(array({ssn}), '', (s, x) -> {parted})"
    inner = f"substr({d}, 2, length({d}) - 2)"
    half, other = (f"cast(pow(10, {h}) as bigint)" for h in (f"(length({d}) - 2) div 2", f"(length({d}) - 1) div 2"))
    middle = f"lpad(cast({cipher.number('card', f'cast({inner} as bigint)', half, other)} as string), length({d}) - 2, '0')"
    card = f"aggregate(array(concat(substr({d}, 1, 1), {middle})), '', (s, b) -> concat(b, {_check_digit('b')}))"
    # Joined digits that count as a whole must do so afterwards: on, until no usual writing within them is valid.
    inside = f"{_usual('w')} <> w and {_valid_card(_usual('w'))}"
    step = _refilled("w", card.replace(m, "w"))
    walked = f"aggregate(sequence(1, {WALK}), {m}, (w, t) -> if(t = 1 or ({inside}), {step}, w))"
    return (
        f"case {v}.k when 'email' then {cipher.email(m)} "
        f"when 'phone' then {_refilled(m, f'concat(substr({d}, 1, 1), {phone})')} "
        f"when 'ip' then {address} {dates} when 'ssn' then {number} "
        f"when 'card' then if({_usual(m)} in ('', {m}), {_refilled(m, card)}, {walked}) else {m} end"
    )


def pseudonymise(
    docs: DataFrame, text: str, key: str, *, inverse: bool = False, counts: bool = True
) -> DataFrame:
    """``docs`` with the column ``text`` pseudonymised (``inverse``: restored) and a count of each kind.

    All other columns stay as they are; those named n_email, n_phone, n_ip,
    n_date, n_ssn, n_card are replaced by the counts (long). A null text stays
    null with counts of 0. Texts of any length are read whole; repeated rows stay.
    """
    out = docs.columns
    value = F.col(text).cast("string")
    has = F.coalesce(value.rlike("[0-9@]"), F.lit(False))
    internal, rewritten = "_found", "_rewritten"
    while internal in out or rewritten in out:
        internal, rewritten = internal + "_", rewritten + "_"
    parsed = docs.withColumn(
        internal,
        F.when(has, F.regexp_extract_all(value, F.lit(ANY), F.lit(0))).otherwise(F.array().cast("array<string>")),
    ).withColumn(
        internal,
        F.expr(
            f"transform(`{internal}`, o -> transform(array({_card_of('o')}), m -> named_struct('m', m, 'k', {kind_sql('m')}, "
            "'a', substr(o, 1, instr(o, m) - 1), 'z', substr(o, instr(o, m) + length(m))))[0])"
        ),
    )
    gaps = f"split(cast(`{text}` as string), {_quoted(ANY)}, -1)"
    new = f"transform(`{internal}`, v -> concat(v.a, {_pseudonym_sql('v', _Cipher(key, inverse))}, v.z))"
    joined = f"array_join(zip_with({gaps}, {new}, (g, p) -> concat(g, coalesce(p, ''))), '')"
    result = parsed.withColumn(rewritten, F.expr(f"if(size(`{internal}`) > 0, {joined}, cast(`{text}` as string))"))
    tallies = {
        f"n_{name}": F.expr(f"cast(size(filter(`{internal}`, v -> v.k {test})) as bigint)")
        for name, test in (
            ("email", "= 'email'"), ("phone", "= 'phone'"), ("ip", "= 'ip'"), ("date", "like '%date'"),
            ("ssn", "= 'ssn'"), ("card", "= 'card'"),
        )
    }
    kept = [F.col(rewritten).alias(c) if c == text else F.col(f"`{c}`") for c in out if not (counts and c in tallies)]
    return result.select(*kept, *([c.alias(n) for n, c in tallies.items()] if counts else []))


def op9_feistel_pseudonyms(spark, sf_dir):
    """All documents: doc_id, the pseudonymised text, and how many values of each kind were replaced."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return pseudonymise(docs, "text", "trendloom-demo-key")
