"""Product descriptions: chain prefixes and keyword categories."""

from __future__ import annotations

from functools import reduce
from operator import and_, or_

from pyspark.sql import Column
from pyspark.sql import functions as F

# Prefixes some chains put before the description, stripped in this order.
DESCRIPTION_PREFIXES = (("DISC", r"^DISC[: ]+"), ("HVDC", r"^HVDC[: ]+"))

# Category rules on the upper-cased description, first match wins.
# (category, any of these patterns, all of these patterns, none of these patterns)
CATEGORY_RULES = (
    ("Lacteos", ("%LECHE%",), (), ()),
    ("Lacteos", ("%YOGUR%",), (), ()),
    ("Lacteos", ("%QUESO%",), (), ()),
    ("Lacteos", ("%MANTECA%",), (), ()),
    ("Lacteos", (), ("%CREMA%", "%LECHE%"), ()),
    ("Aceites", ("%ACEITE%",), (), ()),
    ("Infusiones", ("%YERBA%",), (), ()),
    ("Infusiones", ("%CAFE %", "%CAFÉ%"), (), ()),
    ("Infusiones", ("%TE %",), (), ("%ACEITE%",)),
    ("Infusiones", ("%MATE COCIDO%",), (), ()),
    ("Panificados", ("%PAN %", "%PAN LACTAL%"), (), ()),
    ("Panificados", ("%HARINA%",), (), ()),
    ("Panificados", ("%GALLETITA%", "%GALLETA%"), (), ()),
    ("Pastas", ("%FIDEOS%", "%PASTA%"), (), ()),
    ("Pastas", ("%RAVIOLES%", "%ÑOQUI%"), (), ()),
    ("Arroz y Legumbres", ("%ARROZ%",), (), ()),
    ("Arroz y Legumbres", ("%LENTEJAS%", "%POROTOS%"), (), ()),
    ("Azucar", ("%AZUCAR%", "%AZÚCAR%"), (), ()),
    ("Bebidas Alcoholicas", ("%CERVEZA%",), (), ()),
    ("Bebidas Alcoholicas", ("%VINO%",), (), ()),
    ("Bebidas Alcoholicas", ("%FERNET%",), (), ()),
    ("Bebidas Alcoholicas", ("%WHISKY%", "%VODKA%"), (), ()),
    ("Gaseosas", ("%COCA%COLA%",), (), ()),
    ("Gaseosas", ("%PEPSI%",), (), ()),
    ("Gaseosas", ("%SPRITE%",), (), ()),
    ("Gaseosas", ("%FANTA%",), (), ()),
    ("Gaseosas", ("%7%UP%", "%7UP%"), (), ()),
    ("Gaseosas", ("%GASEOSA%",), (), ()),
    ("Aguas", ("%AGUA MINERAL%", "%AGUA SIN GAS%"), (), ()),
    ("Aguas", ("%AGUA CON GAS%",), (), ()),
    ("Carnes y Fiambres", ("%JAMON%", "%JAMÓN%"), (), ()),
    ("Carnes y Fiambres", ("%SALCHICH%",), (), ()),
    ("Carnes y Fiambres", ("%MORTADELA%",), (), ()),
    ("Limpieza", ("%DETERGENTE%",), (), ()),
    ("Limpieza", ("%LAVANDINA%",), (), ()),
    ("Limpieza", ("%JABON%ROPA%", "%JABÓN%ROPA%"), (), ()),
    ("Limpieza", ("%DESODORANTE%AMBIENTE%",), (), ()),
    ("Limpieza", ("%LIMPIADOR%",), (), ()),
    ("Higiene Personal", ("%SHAMPOO%", "%SHAMPU%"), (), ()),
    ("Higiene Personal", ("%JABON%TOCADOR%", "%JABÓN%TOCADOR%"), (), ()),
    ("Higiene Personal", ("%PASTA DENTAL%", "%DENTIFRICO%"), (), ()),
    ("Higiene Personal", ("%DESODORANTE%",), (), ("%AMBIENTE%",)),
    ("Higiene Personal", (), ("%TOALLA%", "%FEMENIN%"), ()),
    ("Higiene Personal", ("%PAÑAL%",), (), ()),
    ("Conservas", ("%ATUN%", "%ATÚN%"), (), ()),
    ("Conservas", ("%TOMATE%PELADO%", "%TOMATE%TRITURADO%"), (), ()),
    ("Conservas", ("%SALSA%TOMATE%",), (), ()),
    ("Snacks", ("%PAPAS FRITAS%", "%CHIZITO%"), (), ()),
    ("Snacks", (), ("%PALITO%", "%SALADO%"), ()),
)
OTHER_CATEGORY = "Otros"


def clean_description(c: Column) -> Column:
    """Description without chain prefixes; the regex only runs on rows that carry one."""
    stripped = reduce(lambda acc, p: F.regexp_replace(acc, p[1], ""), DESCRIPTION_PREFIXES, c)
    prefixed = reduce(or_, [c.startswith(word) for word, _ in DESCRIPTION_PREFIXES])
    return F.when(prefixed, stripped).otherwise(c)


def categorize_product(c: Column) -> Column:
    """Keyword category of a description. Apply it to distinct products, not to price rows."""
    upper = F.upper(c)

    def matches(any_of: tuple, all_of: tuple, none_of: tuple) -> Column:
        terms = [reduce(or_, [upper.like(p) for p in any_of])] if any_of else []
        terms += [upper.like(p) for p in all_of]
        terms += [~upper.like(p) for p in none_of]
        return reduce(and_, terms)

    (category, *patterns), *rest = CATEGORY_RULES
    choice = F.when(matches(*patterns), category)
    for category, *patterns in rest:
        choice = choice.when(matches(*patterns), category)
    return choice.otherwise(OTHER_CATEGORY)
