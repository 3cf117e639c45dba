"""Pieces of the counterpart SQL."""

from __future__ import annotations

from starsift.functions.textclean import ABBREVIATIONS, SPACE


def rnd(expression: str, places: int = 6) -> str:
    return f"(round_even(CAST(({expression}) AS DOUBLE) * 1e{places}, 0) / 1e{places})"


def quoted(pattern: str) -> str:
    return "'" + pattern.replace("'", "''") + "'"


def whole_word(pattern: str) -> str:
    """A case-blind pattern whose outer word edges follow Unicode."""
    body = pattern.removeprefix(r"\b").removesuffix(r"\b")
    edge = r"[^\p{L}\p{N}_]"
    head = f"(?:^|{edge})" if pattern.startswith(r"\b") else ""
    tail = f"(?:$|{edge})" if pattern.endswith(r"\b") else ""
    return quoted(f"(?i){head}(?:{body}){tail}")


def simpson(term: str, upper: str, steps: int = 400) -> str:
    """Integral of a term in x from 0 to `upper`."""
    x = f"(i * ({upper}) / {steps}e0)"
    weight = f"(CASE WHEN i = 0 OR i = {steps} THEN 1 WHEN i % 2 = 1 THEN 4 ELSE 2 END)"
    body = term.replace("{x}", x)
    return (
        f"(list_sum(list_transform(range(0, {steps + 1}), lambda i: {weight} * ({body})))"
        f" * ({upper}) / {3 * steps}e0)"
    )


def normal_upper(z: str) -> str:
    held = f"greatest(-30e0, least(30e0, {z}))"
    return f"(0.5e0 - {simpson('exp(-0.5e0 * pow({x}, 2))', held)} / sqrt(2 * pi()))"


def t_two_sided(t: str, dof: str) -> str:
    """Both tails, integrated outwards from |t|, so that small values keep their digits."""
    density = (
        f"exp(lgamma((({dof}) + 1) / 2e0) - lgamma(({dof}) / 2e0)) / sqrt(({dof}) * pi())"
        f" * pow(1 + pow(least(60e0, abs({t})) + {{x}}, 2) / ({dof}), -((({dof}) + 1) / 2e0))"
    )
    return f"least(1e0, 2 * {simpson(density, '30e0', 6000)})"


def chi_square_upper(x: str, dof: str) -> str:
    density = (
        f"2 * pow({{x}}, ({dof}) - 1) * exp(-pow({{x}}, 2) / 2e0)"
        f" / (pow(2e0, ({dof}) / 2e0) * gamma(({dof}) / 2e0))"
    )
    return f"greatest(0e0, 1 - {simpson(density, f'sqrt(least(900e0, {x}))', 1000)})"


def replace_all(expression: str, pattern: str, replacement: str) -> str:
    back = replacement
    for n in "123":
        back = back.replace(f"${n}", f"\\{n}")
    return f"regexp_replace({expression}, {quoted(pattern)}, {quoted(back)}, 'g')"


NOT_SPACE = "[^" + SPACE[1:]
# The steps in their long form, on any white space.
LONG_STEPS = (
    (r"(?i)\[\[[a-z0-9_]+:[^\]]+\]\]", " "),
    (rf"(?i)<br{SPACE}*/?>", ". "),
    (r"\n+", ". "),
    (r"<[^3>][^>]*>", " "),
    (rf"http{NOT_SPACE}+|www\.{NOT_SPACE}+", " "),
    (rf"#+{SPACE}*([^\n]*?){SPACE}*#+", ". $1. "),
    (rf"{SPACE}+-{SPACE}+", ". "),
    (rf"{SPACE}+\*{SPACE}+", ". "),
    (r"([a-z])([.!?])([A-Z])", "$1$2 $3"),
    (rf"{SPACE}+", " "),
    (r"^ | $", ""),
    (rf"{SPACE}+\.", "."),
    (r"\.{2,}", "."),
    (rf"\.{SPACE}*\.", "."),
)


def clean(expression: str) -> str:
    """Normalised text; the entities are those the pages use."""
    out = f"coalesce({expression}, '')"
    for name, char in (("&quot;", '"'), ("&copy;", "©"), ("&middot;", "·"), ("&amp;", "&")):
        out = f"replace({out}, '{name}', '{char}')"
    for pattern, replacement in LONG_STEPS:
        out = replace_all(out, pattern, replacement)
    return out


def strip_spaces(expression: str) -> str:
    return replace_all(expression, f"^{SPACE}+|{SPACE}+$", "")


def model_text(expression: str) -> str:
    return strip_spaces(replace_all(f"lower({clean(expression)})", f"{SPACE}+", " "))


def sentences(expression: str) -> str:
    marked = (
        f"regexp_replace({expression}, {quoted(f'([.!?]){SPACE}+')}, '\\1' || chr(1), 'g')"
    )
    short = "|".join(ABBREVIATIONS)
    pattern = quoted(rf"(^|[^\p{{L}}\p{{N}}])({short}|[A-Z])\.\x01")
    joined = f"regexp_replace({marked}, {pattern}, '\\1\\2. ', 'g')"
    return f"string_split({joined}, chr(1))"


def ctes(*parts: str) -> str:
    return "WITH " + ",\n".join(parts) + "\n"
