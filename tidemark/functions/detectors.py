"""Detector patterns for sensitive text (Java and RE2 syntax).

Each comes with text that every match contains: a value without it is not
searched, as looking for plain text is far cheaper than matching a pattern.
"""

DETECTORS = {
    "email": (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}", "@"),
    "ip_address": (r"\b[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3}\b", "."),
    "phone": (r"\+[0-9]{1,3} \([0-9]{3}\) [0-9]{3}-[0-9]{4}", "+"),
    "national_id": (r"\b[0-9]{3}-[0-9]{2}-[0-9]{4}\b", "-"),
    "card_number": (r"\b[0-9]{16}\b", ""),
}
