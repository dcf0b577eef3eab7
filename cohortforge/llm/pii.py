"""Format-preserving pseudonyms for personal data (DataFrame functions only).

Personal data are found by pattern and checked (card numbers by the Luhn digit,
addresses by octet, IBANs modulo 97, social-security numbers by range, dates by calendar). The free characters of a value are
permuted by a keyed Feistel network inside their alphabet; punctuation, length
and the parts that carry the format stay. Equal values get equal pseudonyms in
every document and different values different ones, so records stay linked;
whoever holds the key can invert the permutation, and nobody else: the rounds use
SHA-256 over the key and the other half. The caller names the key.

A Feistel permutation works on two digit strings of fixed lengths u and v:
round by round one half is shifted by a keyed hash of the other half modulo its size.
Values are mapped as follows:

    card     first 12-18 digits permuted, the Luhn digit set anew
    phone    the last seven digits permuted
    iban     the account's digits permuted, the check digits set anew
    ssn      area, group and serial permuted within the valid ones
    ip       the 32-bit address permuted
    date     the day number permuted within 1900-01-01 to 2079-06-06, later ones up to 2099-12-31
             among themselves
    day      day, month and year of 5.12.1987 or 05/12/1987: pairs up to 12 stay such pairs, so that
             either may be the month; 29 February stays one
    email    letters and digits of the lower-cased address but for the last label
    secret   hex strings and key ids, each kind within its own alphabet

Defined results: null stays null, an empty text stays empty; a text without
personal data is returned as it is; repeated rows and repeated values agree;
other columns are kept and may have any names; an empty table gives an empty
result. Whole texts are read. Nothing is shuffled.
"""

from __future__ import annotations

import hashlib
import secrets

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

ROUNDS, KEY_SETTING = 8, "spark.cohortforge.pii.key"
EDGE = "(?<![0-9A-Za-z])"
# Countries that issue IBANs.
IBAN = ("A[DELTZ]|B[AEGHIRY]|C[HRYZ]|D[EJKO]|E[EGS]|F[IKOR]|G[BEILRT]|H[NRU]|I[ELQST]|JO|K[WZ]|L[BCITUVY]|M[CDEKNRTU]|N[ILO]|OM|P[KLST]|QA|"
        "R[OSU]|S[ACDEIKMOTV]|T[LNR]|UA|V[AG]|XK|YE")
KINDS = {
    "email": r"[A-Za-z0-9_+-][A-Za-z0-9._%+-]*@[A-Za-z0-9](?:[A-Za-z0-9.-]*[A-Za-z0-9])?\.[A-Za-z]{2,24}",
    "ip": EDGE + r"(?<![0-9]\.)(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[1-9]?[0-9])(?:\.(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[1-9]?[0-9])){3}(?!\.?[0-9])",
    "iban": EDGE + f"(?:{IBAN})" + r"[0-9]{2}(?: ?[0-9A-Z]{4}){2,7}(?: ?[0-9A-Z]{1,3})?(?![0-9A-Za-z])",
    "ssn": EDGE + r"(?<!-)(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4}(?!-?[0-9A-Za-z])",
    "day": EDGE + r"(?<![0-9][/.-])[0-3]?[0-9](?:/[0-3]?[0-9]/|[.][0-3]?[0-9][.]|-[0-3]?[0-9]-)(?:19|20)[0-9]{2}(?![/.-]?[0-9])",
    "phone": EDGE + r"(?:\+?[0-9]{1,3}[ .-]?(?:\([0-9]{3}\)|[0-9]{3})[ .-][0-9]{3}[ .-]?[0-9]{4}|\([0-9]{3}\)[ .-]?[0-9]{3}[ .-]?[0-9]{4}"
             r"|[0-9]{3}(?:-[0-9]{3}-|[.][0-9]{3}[.]|[ ][0-9]{3}[ ])[0-9]{4}|\+[1-9](?:[ .()/-]{0,2}[0-9]){7,14})(?![0-9])",
    "date": EDGE + r"(?:19|20)[0-9]{2}-(?:0[1-9]|1[0-2])-(?:0[1-9]|[12][0-9]|3[01])(?![0-9])",
    "card": EDGE + r"[0-9](?:[ -]?[0-9]){12,18}(?![0-9])",
    "key_id": EDGE + r"(?:AKIA|ASIA)[0-9A-Z]{16}(?![0-9A-Za-z])",
    "hex": EDGE + r"(?=[0-9a-f]*[0-9])(?=[0-9a-f]*[a-f])[0-9a-f]{16,128}(?![0-9A-Za-z])",
}
ANY = "|".join(f"(?:{p})" for p in KINDS.values())
FIRST_DAY, DAYS, LAST = "1900-01-01", 65536, 73049
# Pairs of day above 12 and month of a common year: 13 * 17 of them.
LATE = [(d, m) for m in range(1, 13) for d in range(13, [31, 28, 31, 30, 31, 30, 31, 31, 30, 31, 30, 31][m - 1] + 1)]


def _secret(key: str) -> str:
    """The key as 64 hex digits, which may stand in SQL."""
    return hashlib.sha256(key.encode()).hexdigest()


def _keyed(key: str, name: str, *parts: str) -> str:
    """SQL: hex digits of the keyed hash of some values."""
    return f"sha2(concat_ws('|', '{key}', '{name}', {', '.join(parts)}), 256)"


def _feistel(a: str, b: str, size_a: str, size_b: str, key: str, name: str) -> str:
    """SQL for a struct (a, b) after the rounds; ``a`` below ``size_a`` and ``b`` below ``size_b``."""
    shift = lambda other: f"cast(conv(substr({_keyed(key, name, 'r', other)}, 1, 15), 16, 10) as bigint)"
    step = (f"if(r % 2 = 0, struct((s.a + {shift('s.b')}) % {size_a} as a, s.b as b),"
            f" struct(s.a as a, (s.b + {shift('s.a')}) % {size_b} as b))")
    return (f"aggregate(sequence(0, {ROUNDS - 1}), struct(cast({a} as bigint) as a, cast({b} as bigint) as b), (s, r) -> {step})")


def _let(value: str, name: str, body: str) -> str:
    """``body`` with ``name`` bound to a value that is computed once."""
    return f"transform(array({value}), {name} -> {body})[0]"


def _digits(text: str, alphabet: str, key: str, name: str) -> str:
    """SQL: a string over an alphabet, its characters shifted one by one in
    Feistel rounds over its halves; any length, characters outside stay."""
    n = len(alphabet)
    half = f"cast(length({text}) / 2 as int)"

    def move(x: str, y: str) -> str:
        """``x`` moved by the stream that ``y`` and the key give, four hex digits for each character."""
        stream = f"array_join(transform(sequence(0, cast(length({x}) / 16 as int)), j -> {_keyed(key, name, 'r', 'j', y)}), '')"
        place = f"cast((instr('{alphabet}', c) - 1 + cast(conv(substr(w, i * 4 + 1, 4), 16, 10) as bigint)) % {n} as int) + 1"
        return _let(stream, "w", f"array_join(transform(split({x}, ''), (c, i) -> if(instr('{alphabet}', c) = 0 or c = '', c, "
                    f"substr('{alphabet}', {place}, 1))), '')")
    step = (f"if(r % 2 = 0, struct({move('s.a', 's.b')} as a, s.b as b),"
            f" struct(s.a as a, {move('s.b', 's.a')} as b))")
    return _let(f"aggregate(sequence(0, {ROUNDS - 1}), struct(substr({text}, 1, {half}) as a, substr({text}, {half} + 1) as b),"
                f" (s, r) -> {step})", "f", "concat(f.a, f.b)")


def _refill(form: str, digits: str) -> str:
    """SQL: the digits of ``form`` replaced in turn by those of ``digits``."""
    return (f"aggregate(split({form}, ''), struct('' as t, 1 as i), (z, c) -> if(c rlike '[0-9]',"
            f" struct(concat(z.t, substr({digits}, z.i, 1)) as t, z.i + 1 as i), struct(concat(z.t, c) as t, z.i as i)), z -> z.t)")


def _luhn_sum(digits: str) -> str:
    """SQL: Luhn sum of a digit string, its last digit counted once."""
    return (f"aggregate(transform(split(reverse({digits}), ''), (c, i) -> if(c = '', 0, if(i % 2 = 0, cast(c as int),"
            f" if(c >= '5', 2 * cast(c as int) - 9, 2 * cast(c as int))))), 0, (t, x) -> t + x)")


def _card(m: str, key: str) -> str:
    body = _digits("substr(d, 1, length(d) - 1)", "0123456789", key, "card")
    check = f"cast(pmod(10 - pmod({_luhn_sum('concat(p, 0)')}, 10), 10) as string)"
    return _let(f"regexp_replace({m}, '[^0-9]', '')", "d", _let(body, "p", _refill(m, f"concat(p, {check})")))


def _phone(m: str, key: str) -> str:
    last = _feistel("substr(d, -7, 3)", "substr(d, -4)", "1000L", "10000L", key, "phone")
    return _let(f"regexp_replace({m}, '[^0-9]', '')", "d", _let(last, "f", _refill(
        m, "concat(substr(d, 1, length(d) - 7), lpad(cast(f.a as string), 3, '0'), lpad(cast(f.b as string), 4, '0'))")))


def _ip(m: str, key: str) -> str:
    part = lambda i: f"cast(split({m}, '[.]')[{i}] as bigint)"
    f = _feistel(f"{part(0)} * 256 + {part(1)}", f"{part(2)} * 256 + {part(3)}", "65536L", "65536L", key, "ip")
    return _let(f, "f", "concat_ws('.', f.a div 256, f.a % 256, f.b div 256, f.b % 256)")


def _date(m: str, key: str) -> str:
    day = f"datediff(cast({m} as date), date'{FIRST_DAY}')"
    f = _feistel(f"{day} div 256", f"{day} % 256", "256L", "256L", key, "date")
    late = _feistel("(n - 65536) div 683", "(n - 65536) % 683", "11L", "683L", key, "late date")
    moved = (f"if(n < {DAYS}, {_let(f.replace(day, 'n'), 'f', 'f.a * 256 + f.b')}, {DAYS} + {_let(late, 'f', 'f.a * 683 + f.b')})")
    return (f"if(try_cast({m} as date) is null, {m}, "
            + _let(day, "n", f"if(n >= {LAST}, {m}, cast(date_add(date'{FIRST_DAY}', cast({moved} as int)) as string))") + ")")


def _day(m: str, key: str) -> str:
    pairs = "array(" + ",".join(str(d * 100 + n) for d, n in LATE) + ")"
    both = _feistel("(z.a - 1) * 12 + z.b - 1", "z.y", "144L", "200L", key, "day pair")
    late = _feistel("i - 1", "z.y", "221L", "200L", key, "late day")
    leap = _feistel("(z.y div 4 - 1) div 7", "(z.y div 4 - 1) % 7", "7L", "7L", key, "leap day")
    pad = f"if(length({m}) = 10, 2, 1)"
    write = lambda a, b, y: (f"concat(lpad(cast({a} as string), greatest({pad}, length(cast({a} as string))), '0'), z.c,"  # noqa: E731
                             f" lpad(cast({b} as string), greatest({pad}, length(cast({b} as string))), '0'), z.c, cast({y} as string))")
    in_order = lambda d, n, y: f"if(z.a > 12, {write(d, n, y)}, {write(n, d, y)})"
    one = _let(both, "f", write("f.a div 12 + 1", "f.a % 12 + 1", "f.b + 1900"))
    two = _let(late, "f", _let(f"{pairs}[cast(f.a as int)]", "q", in_order("q div 100", "q % 100", "f.b + 1900")))
    three = _let(leap, "f", in_order("29", "2", "1904 + 4 * (f.a * 7 + f.b)"))
    parts = (f"struct(cast(split({m}, '[^0-9]')[0] as int) as a, cast(split({m}, '[^0-9]')[1] as int) as b,"
             f" cast(right({m}, 4) as int) - 1900 as y, substr({m}, -5, 1) as c)")
    # A value that no calendar has stays.
    return _let(parts, "z", _let(f"array_position({pairs}, greatest(z.a, z.b) * 100 + least(z.a, z.b))", "i", f"""case
      when z.a between 1 and 12 and z.b between 1 and 12 then {one}
      when i > 0 then {two}
      when greatest(z.a, z.b) = 29 and least(z.a, z.b) = 2 and z.y % 4 = 0 and z.y > 0 then {three} else {m} end"""))


def _mod97(text: str) -> str:
    """SQL: remainder of a text whose letters stand for 10 to 35."""
    return (f"aggregate(split({text}, ''), 0, (t, c) -> if(c = '', t, if(c between '0' and '9', t * 10 + cast(c as int),"
            " t * 100 + ascii(c) - 55) % 97))")


def _iban(m: str, key: str) -> str:
    account = _digits("substr(d, 5)", "0123456789", key, "iban")
    check = f"lpad(cast(98 - {_mod97("concat(p, substr(d, 1, 2), '00')")} as string), 2, '0')"
    fill = (f"aggregate(split({m}, ''), struct('' as t, 1 as i), (z, c) -> if(c = ' ', struct(concat(z.t, c) as t, z.i as i),"
            " struct(concat(z.t, substr(w, z.i, 1)) as t, z.i + 1 as i)), z -> z.t)")
    good = f"{_mod97('concat(substr(d, 5), substr(d, 1, 4))')} = 1"
    new = _let(account, "p", _let(f"concat(substr(d, 1, 2), {check}, p)", "w", fill))
    rest = f"substr({m}, 6)"  # a card may stand behind what only looks like a country and check digits
    card = _let(f"regexp_replace({rest}, '[^0-9]', '')", "d", f"pmod({_luhn_sum('d')}, 10) = 0")
    other = f"if({rest} rlike r'^(?:{KINDS['card']})$' and {card}, concat(left({m}, 5), {_card(rest, key)}), {m})"
    return _let(f"replace({m}, ' ', '')", "d", f"if({good}, {new}, {other})")


def _ssn(m: str, key: str) -> str:
    area = f"cast(left({m}, 3) as int)"
    f = _feistel(f"({area} - if({area} > 666, 2, 1)) * 99 + cast(substr({m}, 5, 2) as int) - 1", f"cast(right({m}, 4) as int) - 1",
                 "88902L", "9999L", key, "ssn")
    new = "f.a div 99 + if(f.a div 99 >= 665, 2, 1)"
    return _let(f, "f", f"concat_ws('-', lpad(cast({new} as string), 3, '0'), lpad(cast(f.a % 99 + 1 as string), 2, '0'),"
                " lpad(cast(f.b + 1 as string), 4, '0'))")


def _pseudonym(m: str, key: str) -> str:
    """SQL: the pseudonym of a match, or the match itself if a check fails."""
    whole = {k: f"{m} rlike r'^(?:{p})$'" for k, p in KINDS.items()}
    alnum = "0123456789abcdefghijklmnopqrstuvwxyz"
    valid = f"pmod({_luhn_sum('d')}, 10) = 0"
    top = f"concat('.', substring_index(lower({m}), '.', -1))"
    luhn = _let(f"regexp_replace({m}, '[^0-9]', '')", "d", valid)
    email = f"concat({_digits(f'substr(lower({m}), 1, length({m}) - length({top}))', alnum, key, 'email')}, {top})"
    return f"""case when instr({m}, '@') > 0 then {email}
      when {whole['ip']} then {_ip(m, key)}
      when {whole['iban']} then {_iban(m, key)}
      when {whole['ssn']} then {_ssn(m, key)}
      when {whole['day']} then {_day(m, key)}
      when {whole['phone']} and not ({whole['card']} and {luhn}) then {_phone(m, key)}
      when {whole['date']} then {_date(m, key)}
      when {whole['card']} then if({luhn}, {_card(m, key)}, {m})
      when {whole['key_id']} then concat(substr({m}, 1, 4), {_digits(f'substr({m}, 5)', '0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZ', key, 'key_id')})
      else {_digits(m, '0123456789abcdef', key, 'hex')} end"""


def kind_counts(found: Column) -> Column:
    """Number of matches of each kind in an array of matches, as a struct."""
    return F.struct(*[F.size(F.filter(found, lambda x, p=p: x.rlike(f"^(?:{p})$"))).cast("long").alias(k) for k, p in KINDS.items()])


def session_key(spark: SparkSession) -> str:
    """The key that the session names in ``KEY_SETTING``; where it names none, one is
    drawn and kept there, so that pseudonyms agree within the session only."""
    key = spark.conf.get(KEY_SETTING, None)
    if not key:
        key = secrets.token_hex(32)
        spark.conf.set(KEY_SETTING, key)
    return key


def pseudonymize(docs: DataFrame, key: str, text: str = "text", n_found: str | None = None) -> DataFrame:
    """The rows with personal data in ``text`` replaced under a secret ``key``; with
    ``n_found`` also the number of replaced values."""
    key = _secret(key)
    names = docs.columns
    rows = docs.select(F.struct(*[docs[c] for c in names]).alias("row"))
    body = F.col("row")[text]
    rows = rows.select("row", body.alias("body"), F.regexp_extract_all(body, F.lit(ANY), F.lit(0)).alias("found"))
    rows = rows.withColumn("swap", F.expr(f"transform(found, m -> {_pseudonym('m', key)})"))
    between = F.split("body", ANY)
    done = F.when(F.size("found") == 0, F.col("body")).otherwise(F.array_join(
        F.transform(F.arrays_zip(between.alias("b"), F.col("swap").alias("s")),
                    lambda x: F.concat(x["b"], F.coalesce(x["s"], F.lit("")))), ""))
    n = F.coalesce(F.size(F.filter(F.arrays_zip("found", "swap"), lambda x: x["found"] != x["swap"])), F.lit(0)).cast("long")
    out = [(done if c == text else F.col("row")[c]).alias(c) for c in names]
    return rows.select(*out, *([n.alias(n_found)] if n_found else []))
