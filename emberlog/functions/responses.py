"""Prompt text and tolerant reading of model answers, as columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from emberlog.functions.scalars import fixed_text

# The prompt, with its fields in order.
PROMPT = """\
Eres un ingeniero experto en operaciones IT analizando logs de sistema.
Se detectó una anomalía en el nodo %s a las %s.

Contexto de los últimos 5 minutos:
- Eventos totales: %s
- Errores: %s (%s del total)
- Warnings: %s
- Fatales: %s
- Componentes afectados: %s
- Severidad promedio (escala 0-4): %s
- Mensajes representativos:
%s

Anomaly score: %s

Proporciona un análisis estructurado con exactamente este formato JSON:
{
  "resumen": "<2 oraciones máximo describiendo el incidente>",
  "severidad": "<LOW|MEDIUM|HIGH|CRITICAL>",
  "causa_probable": "<causa técnica probable>",
  "accion_recomendada": "<acción inmediata concreta>"
}
Responde únicamente con el JSON, sin texto adicional."""
PROMPT_FIELDS = (
    "node", "timestamp", "total_events", "error_count", "error_rate", "warning_count", "fatal_count",
    "components", "avg_severity", "sample_messages",
)

# Answer fields, and the texts used when an answer is missing or unreadable.
ANSWER_FIELDS = ("resumen", "severidad", "causa_probable", "accion_recomendada")
NO_CLIENT = {
    "resumen": "LLM not available — summary skipped.",
    "severidad": "UNKNOWN",
    "causa_probable": "LLM not available",
    "accion_recomendada": "Review logs manually",
}
CUT_ANSWER = {"resumen": "N/A", "severidad": "UNKNOWN", "causa_probable": "N/A", "accion_recomendada": "N/A"}
UNREADABLE = {
    "severidad": "UNKNOWN",
    "causa_probable": "Could not parse LLM response",
    "accion_recomendada": "Review logs manually",
}
ABSENT_KEY = {"resumen": "", "severidad": "UNKNOWN", "causa_probable": "", "accion_recomendada": ""}


def render_prompt(score: Column) -> Column:
    return F.format_string(PROMPT, *[F.col(c).cast("string") for c in PROMPT_FIELDS], fixed_text(score, 4))


def _clean(text: Column) -> Column:
    def strip(c):
        return F.regexp_replace(c, r"^\s+|\s+$", "")

    bare = strip(text)
    body = F.regexp_replace(F.regexp_replace(bare, r"^```[^\n]*\n?", ""), r"(^|\n)[^\S\n]*```$", "")
    return F.when(bare.startswith("```"), strip(body)).otherwise(bare)


def parse_answers(df: DataFrame, text: str = "response") -> DataFrame:
    """Add the four answer fields read from ``text``.

    Code fences are removed; then the outermost braces are read as JSON, if they
    hold one object and nothing behind it; then complete ``"key": "value"`` pairs are picked from a cut answer; what is
    still unreadable keeps its first 300 characters.
    """
    schema = ", ".join(f"{f} string" for f in ANSWER_FIELDS) + ", _bad string"
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_bad", "allowSingleQuotes": "false"}
    out = df.withColumn("_clean", _clean(F.coalesce(F.col(text), F.lit(""))))
    out = out.withColumn("_doc", F.from_json(F.regexp_extract("_clean", r"(?s)\{.*\}", 0), schema, options))
    # as the only element of an array, text behind the object makes it unreadable or longer
    alone = F.from_json(F.concat(F.lit("["), F.regexp_extract("_clean", r"(?s)\{.*\}", 0), F.lit("]")), "array<map<string,string>>", {"allowSingleQuotes": "false"})
    out = out.withColumn("_alone", F.coalesce(F.size(alone) == 1, F.lit(False)))
    whole = F.col("_alone") & F.col("_doc").isNotNull() & F.col("_doc._bad").isNull() & F.col("_clean").rlike(r"(?s)\{.*\}")

    def pair(f):
        return rf'"{f}"\s*:\s*"([^"\\]*+(?:\\.[^"\\]*+)*+)"'

    any_pair = F.lit(False)
    for f in ANSWER_FIELDS:
        any_pair = any_pair | F.col("_clean").rlike(pair(f))
    fields = []
    for f in ANSWER_FIELDS:
        from_pair = F.when(F.col("_clean").rlike(pair(f)), F.regexp_extract("_clean", pair(f), 1)).otherwise(CUT_ANSWER[f])
        last = F.substring("_clean", 1, 300) if f == "resumen" else F.lit(UNREADABLE[f])
        fields.append(
            F.when(whole, F.coalesce(F.col(f"_doc.{f}"), F.lit(ABSENT_KEY[f])))
            .when(any_pair, from_pair)
            .otherwise(last)
            .alias(f)
        )
    return out.select(*df.columns, *fields)
