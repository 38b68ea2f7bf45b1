"""Scalar rules: blank text is NULL, NULL joins as nothing, money has two places."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY = "decimal(18,2)"


def blank_to_null(c: Column) -> Column:
    """Empty text counts as missing."""
    return F.nullif(c, F.lit(""))


def digits(c: Column) -> Column:
    """Keep the digits of a text; nothing left means NULL."""
    text = c.cast("string")
    return F.when(text.rlike("[0-9]"), F.regexp_replace(text, "[^0-9]+", ""))


def number_text(c: Column) -> Column:
    """A digit text read as a number and printed again (drops leading zeros)."""
    return c.try_cast("decimal(38,0)").cast("string")


def text_number(c: Column) -> Column:
    """Number kept as text, with either decimal mark; bad text is NULL."""
    return F.replace(c, F.lit(","), F.lit(".")).try_cast(MONEY)


def money(c: Column) -> Column:
    return c.cast(MONEY)


def joined(*parts: Column) -> Column:
    """Concatenate with NULL as empty text."""
    return F.concat(*[F.coalesce(p.cast("string"), F.lit("")) for p in parts])


def cco_code(c: Column) -> Column:
    """All but the last two digits, as ten characters; NULL when nothing is left."""
    s = c.cast("string")
    head = blank_to_null(F.substring(s, F.lit(1), F.length(s) - 2))
    return F.lpad(head, 10, "0")


def cco_check(c: Column) -> Column:
    """The last two digits, padded to two characters."""
    s = c.cast("string")
    return F.lpad(F.substring(s, F.greatest(F.length(s) - 1, F.lit(1)), F.lit(2)), 2, "0")


def split_cco(c: Column) -> tuple[Column, Column]:
    """Beneficiary number -> (ten-digit code, two-digit check)."""
    return cco_code(c), cco_check(c)


def payee(principal: Column, executing: Column) -> Column:
    """Provider a claim line is paid to: the executing one, else the principal."""
    return F.coalesce(executing, principal)


def hour_text(c: Column) -> Column:
    """Hour text as the statements print it: 12-hour, month, second."""
    return F.date_format(c, "hh:MM:ss")


def back_to_front_period(c: Column) -> Column:
    """'YYYYMM' -> 'MMYYYY'."""
    return F.concat(F.substring(c, 5, 2), F.substring(c, 1, 4))


def poison_sum(c: Column) -> Column:
    """Sum that is NULL as soon as one input is NULL."""
    return F.when(F.count(c) == F.count(F.lit(1)), F.sum(c))


def critique_line(procedure: Column, message: Column) -> Column:
    return F.concat(joined(procedure), F.lit(" : "), joined(message), F.lit("\n"))


def verdict(condition: Column, code: str, text: Column | str) -> Column:
    """Struct (cd_glosa, ds_glosa) when the rule fails, NULL otherwise."""
    text = F.lit(text) if isinstance(text, str) else text
    return F.when(condition, F.struct(F.lit(code).alias("cd_glosa"), text.alias("ds_glosa")))



# Fields of a date text by the letters of its form: digits, least and largest value, what to say otherwise.
_FIELDS = {
    "Y": (4, 1, 9999, "ANO INVALIDO"),
    "M": (2, 1, 12, "MES INVALIDO"),
    "D": (2, 1, 31, "DIA INVALIDO"),
    "h": (2, 0, 23, "HORA INVALIDA"),
    "m": (2, 0, 59, "MINUTO INVALIDO"),
    "s": (2, 0, 59, "SEGUNDO INVALIDO"),
}
_TIME = "hms"
NO_DIGITS, TOO_SHORT, TOO_LONG = "CARACTER NAO NUMERICO", "TEXTO CURTO DEMAIS", "TEXTO LONGO DEMAIS"
NOT_IN_MONTH = "DIA NAO EXISTE NO MES"


def _date_pattern(form: str, closed: bool) -> str:
    """Each field with fewer digits if a separator follows, or with all of them; the time may end early."""
    between = r"(?:\s*[^0-9A-Za-z\s]\s*|\s+)"
    out, ends = r"^\s*", ""
    for i, f in enumerate(form):
        width = _FIELDS[f][0]
        if f in _TIME:
            out += "(?:"
            ends += ")?"
        last = i == len(form) - 1
        stop = rf"(?={between}|$)" if f in _TIME or form[i + 1 : i + 2] in _TIME else f"(?={between})"
        out += rf"([0-9]{{1,{width}}}{'' if last else stop}|[0-9]{{{width}}})" + ("" if last else f"(?:{between})?")
    return out + ends + (r"\s*$" if closed else "")


def _plain_time(text: Column) -> Column:
    """The time of a text written YYYY-MM-DD hh:mm:ss in full that exists; NULL for every other text."""
    plain = text.rlike(r"^(?!0000)[0-9]{4}-[0-9]{2}-[0-9]{2} [0-9]{2}:[0-9]{2}:[0-9]{2}\z")
    return F.when(plain, text.try_cast("timestamp_ntz"))


def lenient_time(text: Column, form: str) -> Column:
    """(ts, cause) of a date text in the order of ``form``, letters of ``_FIELDS``, by the database's lenient rule.

    Fields may lack leading zeros where a separator follows, any punctuation or blank separates, separators may be missing
    between fields of full width, extra blanks do not count, and time fields at the end may be left out and are zero. A text that
    goes on after its last field, has no digit where one is due, or names a date that does not exist has no ``ts``; ``cause`` says
    why. NULL gives NULL in both.
    """
    whole, open_ = _date_pattern(form, True), _date_pattern(form, False)
    name = {f: f"n{i}" for i, f in enumerate(_FIELDS)}  # M and m are one name to Spark
    # one pass of the pattern: the fields and the rest behind a mark that no text in the form starts with
    groups = "".join(f"${i + 1}," for i in range(len(form)))
    tail = f"${len(form) + 1}"

    def read(sent: Column) -> Column:
        cut = F.split(F.regexp_replace(sent, open_ + r"([\s\S]*)$", f"#,{groups}{tail}"), ",", len(form) + 2)
        return F.struct(sent.alias("sent"), (~sent.startswith("#") & (cut[0] == "#")).alias("fits"), cut.alias("cut"))

    def numbered(r: Column) -> Column:
        value = {f: F.coalesce(F.nullif(F.get(r["cut"], F.lit(i + 1)), F.lit("")).cast("int"), F.lit(0)) for i, f in enumerate(form)}
        numbers = [F.when(r["fits"], value[f]).otherwise(0).alias(name[f]) if f in form else F.lit(0).alias(name[f]) for f in _FIELDS]
        return F.struct(r["sent"].alias("sent"), r["fits"].alias("fits"), F.get(r["cut"], F.lit(len(form) + 1)).alias("rest"), *numbers)

    def judged(r: Column) -> Column:
        value, sent = {f: r[name[f]] for f in _FIELDS}, r["sent"]
        wrong = {f: (value[f] < low) | (value[f] > high) for f, (_, low, high, _m) in _FIELDS.items() if f in form}
        in_range = ~reduce(Column.__or__, wrong.values())
        first = F.make_date(value["Y"], value["M"], F.lit(1))
        exists = F.when(in_range, value["D"] <= F.dayofmonth(F.last_day(first)))
        cause = (
            F.when(sent.isNull(), F.lit(None))
            .when(~r["fits"], F.when(sent.rlike(r"[^0-9\W]|_"), NO_DIGITS).otherwise(TOO_SHORT))
            .when(~in_range, F.coalesce(*[F.when(wrong[f], _FIELDS[f][3]) for f in wrong]))
            .when(~exists, NOT_IN_MONTH)
            .when((r["rest"] != "") & ~sent.rlike(whole), TOO_LONG)
        )
        return F.struct(sent.alias("sent"), *[value[f].alias(name[f]) for f in _FIELDS], cause.alias("cause"))

    def made(r: Column) -> Column:
        ts = F.make_timestamp_ntz(*[r[name[f]] for f in "YMDhm"], r[name["s"]].cast("decimal(16,6)"))
        return F.struct(F.when(r["sent"].isNotNull() & r["cause"].isNull(), ts).alias("ts"), r["cause"].alias("cause"))

    # each step is bound once a row: spelt out, the conditions repeat the pattern until the compiled code is too large
    found = reduce(F.transform, (read, numbered, judged, made), F.array(text))[0]
    if form != "YMDhms":
        return found
    # nearly every text is written in full, and reading it needs none of the above
    plain = _plain_time(text)
    return F.when(plain.isNotNull(), F.struct(plain.alias("ts"), F.lit(None).cast("string").alias("cause"))).otherwise(found)
