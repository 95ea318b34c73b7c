"""Thresholds and fixed value lists.

The scoring rules are parameters (frozen dataclasses); their defaults are the
values the scores must reproduce.  The lists at the bottom are fixed values that
must stay exactly as written for results to match.
"""

from __future__ import annotations

from dataclasses import dataclass, field


@dataclass(frozen=True)
class LoginRiskRules:
    """Risk bands of failed-login groups (inclusive bounds, first match wins)."""

    burst_count: int = 5  # count >= burst_count enters the time bands
    band_100_s: int = 60  # span <= this -> 100
    band_80_s: int = 300  # span <= this -> 80
    band_50_s: int = 3600  # span <= this -> 50; otherwise 30
    repeat_count: int = 3  # count >= repeat_count (below burst) -> 20; else 10


#: Bands stretched to days so that every branch occurs on the day-spread driver data.
SCALED_LOGIN_RISK = LoginRiskRules(band_100_s=12 * 86400, band_80_s=16 * 86400, band_50_s=20 * 86400)


@dataclass(frozen=True)
class TrafficRules:
    suspicious_ports: tuple[int, ...] = (22, 3389, 445, 1433, 3306, 5432)
    large_packet_bytes: int = 1000  # strictly greater is large
    rapid_gap_s: int = 1  # whole-second gap strictly below this is rapid


@dataclass(frozen=True)
class AlertRules:
    severity_scores: tuple[tuple[str, int], ...] = (("HIGH", 100), ("MEDIUM", 50), ("LOW", 20))
    default_score: int = 10
    # (lower bound, priority), checked in order; below the last -> default priority
    priority_bands: tuple[tuple[int, str], ...] = ((80, "CRITICAL"), (50, "HIGH"), (20, "MEDIUM"))
    default_priority: str = "LOW"
    action_min_score: int = 50


@dataclass(frozen=True)
class Zones:
    """Address zones as (zone, prefix /24 networks)."""

    internal: tuple[str, ...] = ("192.168.1.0/24", "10.0.0.0/24", "172.16.0.0/24")
    external: tuple[str, ...] = ("203.0.113.0/24", "198.51.100.0/24")
    other: str = "unknown"

    def ranges(self) -> list[tuple[str, str]]:
        return [("internal", n) for n in self.internal] + [("external", n) for n in self.external]


@dataclass(frozen=True)
class PipelineConfig:
    logins: LoginRiskRules = field(default_factory=LoginRiskRules)
    traffic: TrafficRules = field(default_factory=TrafficRules)
    alerts: AlertRules = field(default_factory=AlertRules)
    high_risk: int = 80  # dashboard card threshold (>=)
    high_anomaly: int = 80  # dashboard card threshold (>=)
    summary_anomaly: int = 50  # run summary threshold (>)
    urgent_priorities: tuple[str, ...] = ("CRITICAL", "HIGH")


# ---------------------------------------------------------------------------
# Fixed values (must stay exactly as written: they define the data views and
# the report order).
# ---------------------------------------------------------------------------

PRIORITY_ORDER = ("CRITICAL", "HIGH", "MEDIUM", "LOW")

# Report time ranges: name -> interval (None: no bound).
TIME_RANGES = (("all", None), ("24h", "24 hours"), ("7d", "7 days"), ("30d", "30 days"))

LOCATIONS = (
    "New York, USA",
    "Los Angeles, USA",
    "London, UK",
    "Toronto, Canada",
    "Sydney, Australia",
    "Tokyo, Japan",
    "Berlin, Germany",
    "Mumbai, India",
    "Beijing, China",
    "Moscow, Russia",
)

PROTOCOLS = ("TCP", "UDP", "HTTP", "HTTPS", "DNS", "SMTP", "SSH", "FTP")

ALERT_TYPES = (
    "Brute Force",
    "SQL Injection",
    "Cross-Site Scripting",
    "Privilege Escalation",
    "Data Exfiltration",
    "Malware Detected",
    "Ransomware",
    "DDoS Attack",
    "Phishing Attempt",
    "Suspicious Login",
)

# Login address by event_id % 4 (two internal, two external).
LOGIN_ADDRESSES = ("192.168.1.10", "10.0.0.10", "203.0.113.10", "198.51.100.10")

# Destination port by l_partkey % 12.
TRAFFIC_PORTS = (80, 443, 53, 25, 110, 143, 22, 3389, 1433, 3306, 445, 21)

# Order priority -> alert severity.
SEVERITY_BY_ORDER_PRIORITY = (
    ("1-URGENT", "HIGH"),
    ("2-HIGH", "HIGH"),
    ("3-MEDIUM", "MEDIUM"),
    ("4-NOT SPECIFIED", "INFO"),
    ("5-LOW", "LOW"),
)
