"""SQL expressions over JSON values held as VARIANT.

Built as text: the rules of one document are some hundred function calls, which
the SQL parser reads faster than Column objects can be made one by one.
Arguments are names of columns or of lambda variables.
"""

from __future__ import annotations

# Number texts that only the JVM reads (type suffixes, hexadecimal), and number
# texts that it does not (underscores between digits).
_JVM_ONLY = "(?i)([0-9.][df] *$|0x)"
_GROUPED_DIGITS = "[0-9](_?[0-9])*"
_GROUPED_NUMBER = (
    f"(?i)^[ ]*[+-]?({_GROUPED_DIGITS}[.]?({_GROUPED_DIGITS})?|[.]{_GROUPED_DIGITS})"
    f"(e[+-]?{_GROUPED_DIGITS})?[ ]*$"
)
_GROUPED_INTEGER = f"^[ ]*[+-]?{_GROUPED_DIGITS}[ ]*$"
# A list in plain form: whole numbers at 0, 6 and 8, and no sign, exponent or name anywhere.
_WHOLE, _DECIMAL = "[0-9]{1,18}", "[0-9]{1,18}([.][0-9]+)?"
PLAIN_LIST = (
    f"^{_WHOLE},({_DECIMAL},){{5}}{_WHOLE},{_DECIMAL},{_WHOLE},{_DECIMAL},{_DECIMAL}$"
)
NO_FLAGS = "cast(array() AS array<boolean>)"
_WEEK_FORM = "^([0-9]{4})-?W([0-9]{2})(?:-?([1-7]))?$"


def bind(value: str, name: str, body: str) -> str:
    """``body`` with ``name`` standing for a value that is computed once."""
    return f"get(transform(array({value}), {name} -> {body}), 0)"


def document(text: str) -> str:
    """The JSON value of a whole text, NULL unless the text is exactly one value.

    The text is parsed as the only element of a list, which rejects anything
    after the value. Bare NaN and Infinity are accepted as numbers.
    """
    parsed = (
        f"from_json(concat('[', {text}, ']'), 'array<variant>', "
        "map('allowSingleQuotes', 'false'))"
    )
    return bind(parsed, "_values", "CASE WHEN size(_values) = 1 THEN get(_values, 0) END")


def fields(value: str) -> str:
    """An object as a map of values, NULL for anything else. A null field stays an entry."""
    return f"try_variant_get({value}, '$', 'map<string,variant>')"


def field(entries: str, name: str) -> str:
    return f"try_element_at({entries}, '{name}')"


def elements(value: str) -> str:
    """A list as an array of values, NULL for anything else."""
    return f"try_variant_get({value}, '$', 'array<variant>')"


def text(value: str) -> str:
    return f"try_variant_get({value}, '$', 'string')"


def is_string(value: str) -> str:
    return f"schema_of_variant({value}) = 'STRING'"


def number(value: str) -> str:
    """Value of a number, boolean or number text; NULL for anything else."""
    grouped = f"try_cast(replace({text(value)}, '_', '') AS DOUBLE)"
    return bind(
        f"try_variant_get({value}, '$', 'double')",
        "_n",
        f"CASE WHEN _n IS NULL THEN CASE WHEN {text(value)} RLIKE '{_GROUPED_NUMBER}' "
        f"THEN {grouped} END WHEN {is_string(value)} AND {text(value)} RLIKE '{_JVM_ONLY}' "
        "THEN NULL ELSE _n END",
    )


def integer(value: str) -> str:
    """Value of a finite number cut to its whole part, or of a whole-number text.

    Whole numbers beyond 64 bits come out as the nearest 64-bit value.
    """
    beyond = f"try_cast(replace({text(value)}, '_', '') AS DECIMAL(38, 0))"
    clamped = (
        f"CAST(greatest(least({beyond}, 9223372036854775807), -9223372036854775807) AS BIGINT)"
    )
    finite = f"abs(try_variant_get({value}, '$', 'double')) < double('Infinity')"
    return (
        f"CASE WHEN {is_string(value)} THEN CASE WHEN {text(value)} RLIKE '{_GROUPED_INTEGER}' "
        f"THEN coalesce(try_cast({text(value)} AS BIGINT), {clamped}) END "
        f"ELSE coalesce(try_variant_get({value}, '$', 'bigint'), "
        f"CASE WHEN {finite} THEN {clamped} END) END"
    )


def iso_date(text: str) -> str:
    """Date of an ISO 8601 calendar or week date text, NULL for anything else."""

    def part(no: int) -> str:
        return f"regexp_extract({text}, '{_WEEK_FORM}', {no})"

    year, week = f"int({part(1)})", f"int({part(2)})"
    day = f"CASE WHEN {part(3)} = '' THEN 1 ELSE int({part(3)}) END"
    # 4 January is always in week 1, 28 December always in the last week.
    first = f"try_cast(concat({part(1)}, '-01-04') AS DATE)"
    weeks = f"weekofyear(try_cast(concat({part(1)}, '-12-28') AS DATE))"
    monday = f"date_sub({first}, weekday({first}))"
    by_week = (
        f"CASE WHEN {year} > 0 AND {week} BETWEEN 1 AND {weeks} "
        f"THEN date_add({monday}, ({week} - 1) * 7 + {day} - 1) END"
    )
    basic = f"concat_ws('-', left({text}, 4), substring({text}, 5, 2), right({text}, 2))"
    extended_form = "^(?!0000)[0-9]{4}-[0-9]{2}-[0-9]{2}$"
    week_forms = "^[0-9]{4}(-W[0-9]{2}(-[1-7])?|W[0-9]{2}[1-7]?)$"
    return (
        f"CASE WHEN {text} RLIKE '{extended_form}' THEN try_cast({text} AS DATE) "
        f"WHEN {text} RLIKE '^(?!0000)[0-9]{{8}}$' THEN try_cast({basic} AS DATE) "
        f"WHEN {text} RLIKE '{week_forms}' THEN {by_week} END"
    )


def record_date(text: str) -> str:
    """Date in the first ten characters of a text."""
    return bind(f"substring({text}, 1, 10)", "_t", iso_date("_t"))


def repeat_flags(keys: str) -> str:
    """Whether each key of a list occurred earlier in it; NULL keys do not count.

    Empty where no key occurs twice. Else the keys are sorted with their
    positions, compared with the key before and put back in order, so the cost
    does not grow with the square of the list.
    """
    positioned = f"transform({keys}, (k, i) -> named_struct('key', k, 'pos', i))"
    pairs = (
        "zip_with(_k, slice(_k, 2, size(_k)), "
        "(a, b) -> named_struct('pos', b.pos, 'again', a.key = b.key))"
    )
    first = "transform(slice(_k, 1, 1), a -> named_struct('pos', a.pos, 'again', false))"
    # The last pair has no element after it.
    flags = f"concat({first}, filter({pairs}, f -> f.pos IS NOT NULL))"
    marked = f"transform(array_sort({flags}), f -> coalesce(f.again, false))"
    sort = bind(f"array_sort({positioned})", "_k", marked)
    return f"CASE WHEN size(array_distinct({keys})) = size({keys}) THEN {NO_FLAGS} ELSE {sort} END"


def _sign_error(parsed: str, label: str, kind: str) -> str:
    return bind(
        parsed,
        "_x",
        f"CASE WHEN _x IS NULL THEN concat({label}, ' is not {kind}') "
        f"WHEN _x < 0 THEN concat({label}, ' is negative') END",
    )


def number_error(value: str, label: str) -> str:
    """Error text of a value that is no number or is negative, else NULL."""
    return _sign_error(number(value), label, "numeric")


def integer_error(value: str, label: str) -> str:
    return _sign_error(integer(value), label, "an integer")
