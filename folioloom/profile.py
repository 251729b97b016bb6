"""Patterns, tolerances and defaults that operators take as one frozen value."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Profile:
    # Patterns and words of the default (textbook) profile.
    unit_heading: str = r"(?i)^(?:अध्याय|CHAPTER|UNIT)\s*[-—–:]?\s*\d+"
    question: str = r"(?i)^\s*Q(?:UESTION)?\s*\.?\s*(\d+)\s*[.):-]?\s*(.*)$"
    option: str = r"(?i)(?<!\w)\(\s*([A-D])\s*\)"
    answer_line: str = r"^(?:[._\-․…]\s*){8,}$"
    printed_page: str = r"^\d{1,4}$"
    marks_wrap: str = r"(?i)^(?:\d+\s+)?MARKS?\s+QUESTION\)?$"
    mojibake: str = r"Ã.|à[¤¥]|â[\u0080-¿]"
    separator: str = r"^[-_* ]{6,}$"
    type_headings: tuple[str, ...] = (
        "multiple choice question", "fill in the blank", "short answer question", "long answer question",
        "बहुविकल्पीय प्रश्न", "रिक्त स्थान", "लघु उत्तरीय प्रश्न", "दीर्घ उत्तरीय प्रश्न",
    )
    page_types: tuple[tuple[str, tuple[str, ...]], ...] = (
        ("mcq", ("multiple choice", "बहुविकल्पीय")),
        ("fill_blank", ("fill in the blank", "रिक्त स्थान")),
        ("short_answer", ("short answer", "लघु उत्तरीय")),
        ("long_answer", ("long answer", "दीर्घ उत्तरीय")),
    )
    layouts: tuple[tuple[int, str], ...] = ((1, "one_column"), (2, "two_by_two"), (4, "four_inline"))
    # Measures.
    text_pitch: float = 30.5
    answer_pitch: float = 28.5
    pitch_slack: float = 2.25
    sparse_lines: int = 6
    sparse_chars: int = 240
    rule_step: float = 1.5
    least_dpi: float = 300.0
    dpi_slack: float = 0.5


DEFAULT = Profile()
