"""LaTeX formula functions as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from marginalia.functions.text import SPACE, strip

# Commands and their plain-text forms, applied in this order.
PLAIN_TEXT = (
    # Greek letters
    ("\\alpha", "alpha"),
    ("\\beta", "beta"),
    ("\\gamma", "gamma"),
    ("\\delta", "delta"),
    ("\\epsilon", "epsilon"),
    ("\\theta", "theta"),
    ("\\lambda", "lambda"),
    ("\\mu", "mu"),
    ("\\pi", "pi"),
    ("\\sigma", "sigma"),
    ("\\omega", "omega"),
    ("\\Gamma", "Gamma"),
    ("\\Delta", "Delta"),
    ("\\Theta", "Theta"),
    ("\\Lambda", "Lambda"),
    ("\\Sigma", "Sigma"),
    ("\\Omega", "Omega"),
    # operators
    ("\\sum", "sum"),
    ("\\int", "integral"),
    ("\\frac", "/"),
    ("\\sqrt", "sqrt"),
    ("\\times", "*"),
    ("\\div", "/"),
    ("\\pm", "+/-"),
    ("\\leq", "<="),
    ("\\geq", ">="),
    ("\\neq", "!="),
    ("\\approx", "≈"),
    ("\\infty", "infinity"),
    ("\\partial", "partial"),
    ("\\nabla", "nabla"),
    # spacing and size
    ("\\left", ""),
    ("\\right", ""),
    ("\\,", " "),
    ("\\ ", " "),
    ("\\;", " "),
    ("\\quad", " "),
    ("\\qquad", "  "),
)

# Complexity bounds and region rules.
SIMPLE_BELOW = 5
MODERATE_BELOW = 15
MIN_AREA = 200
MIN_ASPECT = 0.5
MAX_ASPECT = 20
CENTER_SHARE = 0.2
WIDTH_SHARE = 0.3


def occurrences(text: Column, mark: str) -> Column:
    """Non-overlapping occurrences of a literal mark."""
    gone = F.length(F.replace(text, F.lit(mark), F.lit("")))
    return ((F.length(text) - gone) / len(mark)).cast("int")


def formula_counts(text: Column) -> Column:
    """Struct of display, inline and total counts from dollar signs."""
    display = (occurrences(text, "$$") / 2).cast("int")
    inline = ((occurrences(text, "$") - display * 4) / 2).cast("int")
    return F.struct(
        display.alias("display"), inline.alias("inline"), (display + inline).alias("total")
    )


def formula_ids(doc_id: Column, chunk_index: Column, total: Column) -> Column:
    """``<doc>_formula_NNNN_NNN`` for 1..total; empty for none."""
    numbers = F.when(total > 0, F.sequence(F.lit(1), total)).otherwise(F.array().cast("array<int>"))
    return F.transform(
        numbers, lambda i: F.format_string("%s_formula_%04d_%03d", doc_id, chunk_index.cast("long"), i)
    )


def element_id(page: Column, index: Column) -> Column:
    return F.format_string("formula_%04d_%04d", page.cast("long"), index.cast("long"))


def clean_latex(latex: Column) -> Column:
    return F.regexp_replace(strip(latex), f"[{SPACE}]+", " ")


def latex_error(latex: Column) -> Column:
    """Why a cleaned LaTeX string is rejected, NULL when it is fine."""
    return F.when(occurrences(latex, "{") != occurrences(latex, "}"), "unbalanced braces").when(
        latex == "", "empty"
    )


def format_latex(latex: Column, kind: Column) -> Column:
    """Cleaned LaTeX in its delimiters; NULL where it is rejected."""
    body = clean_latex(latex)
    fence = F.when(kind == "inline", "$").otherwise("$$")
    return F.when(latex_error(body).isNull(), F.concat(fence, body, fence))


def latex_to_plain(latex: Column) -> Column:
    """Best-effort readable text."""
    text = strip(latex)
    for command, plain in PLAIN_TEXT:
        text = F.replace(text, F.lit(command), F.lit(plain))
    text = F.regexp_replace(text, r"\^\{([^}]+)\}", "^$1")
    text = F.regexp_replace(text, r"_\{([^}]+)\}", "_$1")
    text = F.translate(text, "{}", "")
    return strip(F.regexp_replace(text, f"[{SPACE}]+", " "))


def appendix_entry(number: Column, page: Column, latex: Column, kind: Column) -> Column:
    """Entry of the formula appendix; ``page`` counts from zero."""
    head = F.format_string("Formula %d (page %d):", number.cast("long"), (page + 1).cast("long"))
    body = strip(latex)
    return F.when(kind == "inline", F.concat(head, F.lit(" $"), body, F.lit("$\n\n"))).otherwise(
        F.concat(head, F.lit("\n\n$$"), body, F.lit("$$\n\n"))
    )


def page_entry(number: Column, latex: Column, kind: Column) -> Column:
    """Entry of a per-page formula section."""
    head = F.format_string("Formula %d:", number.cast("long"))
    return F.when(kind == "inline", F.concat(head, F.lit(" $"), latex, F.lit("$\n"))).otherwise(
        F.concat(head, F.lit("\n$$\n"), latex, F.lit("\n$$\n"))
    )


def complexity(total: Column) -> Column:
    return F.when(total < SIMPLE_BELOW, "simple").when(total < MODERATE_BELOW, "moderate").otherwise("complex")


def region_kept(x1: Column, y1: Column, x2: Column, y2: Column) -> Column:
    """Size and shape rules for a detected region."""
    width, height = x2 - x1, y2 - y1
    aspect = width / F.greatest(height, F.lit(1.0))
    return (width * height >= MIN_AREA) & (aspect >= MIN_ASPECT) & (aspect <= MAX_ASPECT)


def region_kind(x1: Column, x2: Column, page_width: Column) -> Column:
    """Display when centred and wide, inline otherwise."""
    centred = F.abs((x1 + x2) / 2 - page_width / 2) < page_width * CENTER_SHARE
    return F.when(centred & (x2 - x1 > page_width * WIDTH_SHARE), "display").otherwise("inline")
