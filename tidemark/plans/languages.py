"""Common words that tell the document classes (languages) apart."""

from tidemark.operators.documents import LabelProfile

LANGUAGES = (
    LabelProfile("de", ("der", "die", "das", "und", "nicht", "ist", "ein", "den", "von", "zu",
                        "auf", "sich", "dem", "des")),
    LabelProfile("en", ("the", "and", "of", "to", "in", "is", "that", "with", "for", "was", "it",
                        "by", "on")),
    LabelProfile("es", ("el", "los", "las", "una", "y", "por", "con", "para", "del", "se", "al",
                        "que")),
    LabelProfile("fr", ("le", "les", "des", "et", "un", "une", "pour", "dans", "est", "qui", "au",
                        "avec", "que")),
)
