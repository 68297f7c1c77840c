"""Tag labels by category and language."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# What a tag of each category is called in each language.
LABELS = {
    "Person": {"en": "Person", "fr": "Personne", "de": "Person", "es": "Persona"},
    "Email": {"en": "Email", "fr": "Courriel", "de": "E-Mail", "es": "Correo"},
    "PhoneNumber": {"en": "Phone", "fr": "Téléphone", "de": "Telefon", "es": "Teléfono"},
    "Address": {"en": "Address", "fr": "Adresse", "de": "Adresse", "es": "Dirección"},
    "Organization": {"en": "Org", "fr": "Org", "de": "Org", "es": "Org"},
    "Date": {"en": "Date", "fr": "Date", "de": "Datum", "es": "Fecha"},
    "IBAN": {"en": "IBAN", "fr": "IBAN", "de": "IBAN", "es": "IBAN"},
    "CreditCard": {"en": "Card", "fr": "Carte", "de": "Karte", "es": "Tarjeta"},
}


def label(category: Column, lang: Column) -> Column:
    """Label of a category in a language; English where the language has none."""
    result = F.lit(None).cast("string")
    for name, by_lang in LABELS.items():
        spelled = F.lit(by_lang["en"])
        for code, word in by_lang.items():
            if word != by_lang["en"]:
                spelled = F.when(lang == code, word).otherwise(spelled)
        result = F.when(category == name, spelled).otherwise(result)
    return result


def tag(category: Column, lang: Column, number: Column) -> Column:
    return F.concat(F.lit("["), label(category, lang), F.lit(" "), number.cast("string"), F.lit("]"))


def label_table(spark: SparkSession) -> DataFrame:
    """The labels as (category, lang, label): 32 rows."""
    rows = [(c, lang, word) for c, by_lang in LABELS.items() for lang, word in by_lang.items()]
    return spark.createDataFrame(rows, "category string, lang string, label string")
