"""Label texts of the derived columns and of the answers, per language."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass


@dataclass(frozen=True)
class LabelSet:
    weekdays: tuple[str, ...]  # Sunday first
    periods: tuple[str, ...]  # small hours, morning, afternoon, evening
    fare_bands: tuple[str, ...]  # cheapest first
    party_sizes: tuple[str, ...]  # one, two, three to four, the rest
    demand: tuple[str, ...]  # morning, evening and night peak, the rest
    day_types: tuple[str, ...]  # weekday, weekend
    indicators: tuple[str, ...]  # trips, revenue, first and second answer
    titles: Mapping[str, str]  # heading of each answer

    def __post_init__(self):
        for texts, size in (
            (self.weekdays, 7),
            (self.periods, 4),
            (self.fare_bands, 4),
            (self.party_sizes, 4),
            (self.demand, 4),
            (self.day_types, 2),
            (self.indicators, 4),
        ):
            # Distinct texts keep the rollup key and its labels one to one.
            if len(texts) != size or len(set(texts)) != size:
                raise ValueError(f"expected {size} distinct labels, got {texts}")


# The layers hold Portuguese texts.
PORTUGUESE = LabelSet(
    weekdays=("Domingo", "Segunda", "Terça", "Quarta", "Quinta", "Sexta", "Sábado"),
    periods=("Madrugada", "Manhã", "Tarde", "Noite"),
    fare_bands=("Baixa", "Média", "Alta", "Premium"),
    party_sizes=("Individual", "Casal", "Família", "Grupo"),
    demand=("Pico Manhã", "Pico Tarde", "Pico Noite", "Normal"),
    day_types=("Dia Útil", "Fim de Semana"),
    indicators=(
        "Total de Viagens",
        "Receita Total",
        "Média Yellow Taxis (Resposta 1)",
        "Média Passageiros Maio (Resposta 2)",
    ),
    titles={
        "q1_main": "PERGUNTA 1 - RESPOSTA PRINCIPAL",
        "q1_monthly": "PERGUNTA 1 - DETALHAMENTO MENSAL",
        "validate_gold": "VALIDAÇÃO GERAL",
    },
)

# English texts. Some are shown by the answers as they are; weekdays, bands and
# some headings are our own translations of the Portuguese ones.
ENGLISH = LabelSet(
    weekdays=("Sunday", "Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday"),
    periods=("Small hours", "Morning", "Afternoon", "Evening"),
    fare_bands=("Low", "Medium", "High", "Premium"),
    party_sizes=("Single", "Couple", "Family", "Group"),
    demand=("Morning Peak", "Evening Peak", "Night Peak", "Normal"),
    day_types=("Weekday", "Weekend"),
    indicators=(
        "Total Trips",
        "Total Revenue",
        "Yellow Taxi Average (Answer 1)",
        "May Passengers Average (Answer 2)",
    ),
    titles={
        "q1_main": "QUESTION 1 - MAIN ANSWER",
        "q1_monthly": "QUESTION 1 - MONTHLY DETAIL",
        "q1_share": "QUESTION 1 - MONTHLY COMPARISON",
        "q2_main": "QUESTION 2 - MAIN ANSWER",
        "q2_peaks": "QUESTION 2 - PEAK ANALYSIS",
        "q2_period": "QUESTION 2 - BY TIME PERIOD",
        "fleet_compare": "COMPLEMENTARY - YELLOW vs GREEN",
        "monthly_evolution": "COMPLEMENTARY - MONTHLY EVOLUTION",
        "top5_hours": "COMPLEMENTARY - TOP HOURS",
        "weekend_split": "COMPLEMENTARY - WEEKEND ANALYSIS",
        "validate_gold": "VALIDATION - DATA QUALITY",
        "validate_coverage": "VALIDATION - TEMPORAL COVERAGE",
        "exec_summary": "EXECUTIVE SUMMARY",
    },
)
