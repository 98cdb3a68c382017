"""Display text of statistics.

Numbers stay numbers until a section is rendered; these functions are that last step.
They take and return SQL expressions (names of columns as a rule), for ``selectExpr`` or
``F.expr``: long expressions are cheap to build that way.

Rounding follows the exact binary value with ties to even, as C and Python print it,
while the JVM formatter rounds the shortest decimal half up, so ties are resolved first.
"""

from __future__ import annotations

# Placeholders and cut-off of displayed text.
DASH = "—"
RANGE_DASH = "–"
NULL_LABEL = "(null)"
LABEL_LIMIT = 60
LABEL_CUT = 57
LABELS_SHOWN = 10

NO_LABELS = "cast(array() as array<string>)"


def let(name: str, value: str, body: str) -> str:
    """``body`` with ``name`` bound to a value computed once per row, however often it is used."""
    return f"transform(array({value}), {name} -> {body})[0]"


def plain(text: str) -> str:
    """Decimal text without trailing zeros."""
    return f"regexp_replace({text}, '[.]?0+$', '')"


def _gap(a: str, b: str, near: str) -> str:
    """Sign of the exact a*b - near: both factors are split into halves whose products are exact."""
    error = "(k.a - k.ah) * (k.b - k.bh) - (((k.p - k.ah * k.bh) - (k.a - k.ah) * k.bh) - k.ah * (k.b - k.bh))"
    halves = ("struct(h.a, h.b, h.ca - (h.ca - h.a) as ah, h.cb - (h.cb - h.b) as bh, h.a * h.b as p)")
    spread = f"struct({a} as a, {b} as b, {a} * 134217729D as ca, {b} * 134217729D as cb)"
    return let("h", spread, let("k", halves, f"(k.p - {near}) + ({error})"))


def _round_five(digits: str, gap: str) -> str:
    """A number ending in 5, in tens, rounded by the sign of the exact remainder, ties to even."""
    tens = f"({digits} div 10)"
    return let("g", gap, f"{tens} + if(g > 0 or (g = 0 and {tens} % 2 = 1), 1, 0)")


def one_decimal(value: str) -> str:
    """``%.1f`` text."""
    tie = "s.h % 10 = 5 and double(s.h) / 100D = s.v"
    nearest = f"double({_round_five('s.h', _gap('s.v', '100D', 'double(s.h)'))}) / 10D"
    size = "struct(n, abs(n) as v, bigint(if(abs(n) < 1e13, round(abs(n) * 100D), null)) as h)"
    exact = let("s", size, f"if(s.n < 0, -1D, 1D) * if({tie}, {nearest}, s.v)")
    return let("n", f"double({value})", f"format_string('%.1f', {exact})")


def _settled_at_three(size: str) -> str:
    """A positive number moved off a four-digit tie onto its three-digit neighbour."""
    whole = "double(s.digits)"
    below = f"s.shift between 0 and 22 and {whole} / s.scale = s.v"
    above = f"s.shift between -18 and -1 and {whole} * s.scale = s.v"
    down = f"double({_round_five('s.digits', _gap('s.v', 's.scale', whole))}) / (s.scale / 10D)"
    up = f"double({_round_five('s.digits', '0D')}) * s.scale * 10D"
    settled = f"case when s.digits % 10 <> 5 then s.v when {below} then {down} when {above} then {up} else s.v end"
    parts = ("struct(e.v, bigint(replace(substring_index(e.t, 'e', 1), '.', '')) as digits, "
             "3 - int(substring_index(e.t, 'e', -1)) as shift, "
             "pow(10D, abs(3D - double(substring_index(e.t, 'e', -1)))) as scale)")
    return let("e", f"struct({size} as v, format_string('%.3e', {size}) as t)", let("s", parts, settled))


def _three_digits(value: str) -> str:
    """``%.3g`` text of a finite number that is not a plain integer."""
    mantissa, power = "substring_index(t, 'e', 1)", "substring_index(t, 'e', -1)"
    scientific = f"concat({plain(mantissa)}, 'e', {power})"
    fixed = plain("format_string('%.10f', double(t))")
    shown = f"if(int({power}) < -4 or int({power}) >= 3, {scientific}, {fixed})"
    text = let("t", f"format_string('%.2e', {_settled_at_three(f'abs({value})')})", shown)
    return f"concat(if({value} < 0, '-', ''), {text})"


def number(value: str) -> str:
    """At most three significant digits; integers below 1e15 plain; a dash for NULL."""
    whole = "n = floor(n) and abs(n) < 1e15"
    shown = (
        f"case when n is null then '{DASH}' when isnan(n) then 'NaN' "
        f"when abs(n) = double('infinity') then if(n > 0, 'Infinity', '-Infinity') "
        f"when {whole} then string(bigint(if({whole}, n, null))) else {_three_digits('n')} end")
    return let("n", f"double({value})", shown)


def numbers(*values: str) -> str:
    """Array of number texts."""
    return f"transform(array({', '.join(f'double({v})' for v in values)}), m -> {number('m')})"


def percent(value: str) -> str:
    return f"if({value} is null, '{DASH}', concat({one_decimal(value)}, '%'))"


def double_label(value: str) -> str:
    """Plain decimal text: ``5`` for 5.0 and no exponent below 1e15."""
    whole = "n = floor(n) and abs(n) < 1e15"
    shown = (f"case when {whole} then string(bigint(if({whole}, n, null))) "
             f"when abs(n) >= 1e7 and abs(n) < 1e15 then {plain('string(try_cast(n as decimal(38,9)))')} "
             f"else string(n) end")
    return let("n", f"double({value})", shown)


def numeric_summary(low: str, high: str, mean: str, std: str) -> str:
    shown = let("t", numbers(low, high, mean, std),
                "concat('Min: ', t[0], ', Max: ', t[1], ', Mean: ', t[2], ' (std: ', t[3], ')')")
    return f"if({low} is null, '', {shown})"


def median_iqr(q1: str, median: str, q3: str) -> str:
    """Column form: short numbers and an en dash."""
    shown = let("t", numbers(q1, median, q3),
                f"concat('Median: ', t[1], ' (IQR: ', t[0], '{RANGE_DASH}', t[2], ')')")
    return f"if({median} is null, '', {shown})"


def variable_median(q1: str, median: str, q3: str) -> str:
    """Variable form: unrounded numbers and a hyphen."""
    shown = (f"concat('Median: ', {double_label(median)}, ' (IQR: ', {double_label(q1)}, '-', "
             f"{double_label(q3)}, ')')")
    return f"if({median} is null, '', {shown})"


def date_range(low: str, high: str) -> str:
    return f"if({low} is null, '', concat('Min: ', {low}, ', Max: ', {high}))"


def cut_label(value: str) -> str:
    return f"if(length({value}) <= {LABEL_LIMIT}, {value}, concat(substring({value}, 1, {LABEL_CUT}), '...'))"


def _share(label: str, total: str) -> str:
    return f"concat({label}, ': ', x.n, ' (', {one_decimal(f'100D * x.n / {total}')}, '%)')"


def value_distribution(top: str, row_count: str) -> str:
    """Column form: ``value: n (p%)`` over all rows, long labels cut."""
    parts = f"transform({top}, x -> {_share(cut_label('x.value'), row_count)})"
    return f"if({top} is null or {row_count} <= 0, '', array_join({parts}, '; '))"


def _shown(label: str) -> str:
    return f"if(coalesce({label}, '') = '', '{NULL_LABEL}', {label})"


def top_labels(top: str) -> str:
    """First ten labels of a variable; empty labels are named."""
    return f"coalesce(transform(slice({top}, 1, {LABELS_SHOWN}), x -> {_shown('x.value')}), {NO_LABELS})"


def variable_distribution(top: str, total: str) -> str:
    """Variable form: share of the scoped non-null rows, labels not cut."""
    parts = f"transform({top}, x -> {_share(_shown('x.value'), total)})"
    return f"if({top} is null or {total} <= 0, '', array_join({parts}, '; '))"


def distribution_cell(distribution: str, top: str) -> str:
    """The distribution text if any, else ``value: n`` pairs."""
    pairs = f"transform({top}, x -> concat({cut_label('x.value')}, ': ', x.n))"
    return f"coalesce(nullif({distribution}, ''), array_join({pairs}, '; '), '')"


def values_cell(top: str) -> str:
    return f"coalesce(array_join(transform(slice({top}, 1, {LABELS_SHOWN}), x -> x.value), ', '), '')"


def observed_values(labels: str) -> str:
    """One label per line, so that commas inside a label are kept."""
    return f"coalesce(array_join({labels}, '\\n'), '')"


def example_value(first_label: str, low: str) -> str:
    """A representative value: the most frequent label, else the lower end of the range."""
    return f"coalesce({first_label}, {low}, '')"


def free_text_note(rows: str) -> str:
    return f"concat(format_number({rows}, 0), ' rows; values not aggregated (free text)')"


def clean(value: str) -> str:
    return f"regexp_replace({value}, '^[ \\\\t\\\\r\\\\n\\\\f]+|[ \\\\t\\\\r\\\\n\\\\f]+$', '')"


def clean_list(items: str) -> str:
    """Trimmed entries, blanks dropped."""
    return f"coalesce(filter(transform({items}, x -> {clean('x')}), x -> x <> ''), {NO_LABELS})"


def clean_map(entries: str) -> str:
    return f"transform_values({entries}, (k, v) -> {clean('v')})"
