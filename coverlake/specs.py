"""Entity contracts: columns, rules, normalisation and derived columns, held in one open registry."""

from __future__ import annotations

from dataclasses import dataclass, field

from coverlake.functions import cells


@dataclass(frozen=True)
class Rule:
    """A test every non-null value must pass: a SQL predicate over `{value}`."""

    name: str
    predicate: str

    def passes(self, value: str) -> str:
        return self.predicate.replace("{value}", value)


@dataclass(frozen=True)
class Field:
    name: str
    kind: str = "text"
    nullable: bool = False
    rules: tuple[Rule, ...] = ()
    required: bool = True


@dataclass(frozen=True)
class EntitySpec:
    """One feed. `derived` maps silver columns to SQL over typed columns, where `{as_of}` is the day ages count to."""

    name: str
    key: str
    fields: tuple[Field, ...]
    upper: tuple[str, ...]
    clipped: dict[str, tuple[float, float]] = field(default_factory=dict)
    derived: dict[str, str] = field(default_factory=dict)

    @property
    def columns(self) -> list[str]:
        return [f.name for f in self.fields]

    @property
    def required(self) -> list[str]:
        return [f.name for f in self.fields if f.required]

    def of_kind(self, *kinds: str) -> list[str]:
        return [f.name for f in self.fields if f.kind in kinds]


def matches(pattern: str) -> Rule:
    return Rule(f"str_matches({pattern})", f"{{value}} RLIKE {cells.quoted(pattern)}")


def one_of(*values: str) -> Rule:
    return Rule("isin", f"{{value}} IN ({cells.listed(list(values))})")


def above(bound: float) -> Rule:
    return Rule(f"greater_than({bound})", f"{{value}} > {bound}")


def at_least(bound: float) -> Rule:
    return Rule(f"greater_than_or_equal_to({bound})", f"{{value}} >= {bound}")


def below(bound: float) -> Rule:
    return Rule(f"less_than({bound})", f"{{value}} < {bound}")


def at_most(bound: float) -> Rule:
    return Rule(f"less_than_or_equal_to({bound})", f"{{value}} <= {bound}")


def since(day: str) -> Rule:
    return Rule(f"since({day})", f"{{value}} >= DATE '{day}'")


def in_range(low: float, high: float) -> Rule:
    return Rule(f"in_range({low}, {high})", f"{{value}} BETWEEN {low} AND {high}")


REGISTRY: dict[str, EntitySpec] = {}


def register(spec: EntitySpec) -> EntitySpec:
    """Add an entity; its order in the registry is the order names are matched in."""
    REGISTRY[spec.name] = spec
    return spec


def get_spec(entity: str) -> EntitySpec:
    if entity not in REGISTRY:
        raise ValueError(f"No contract is registered for {entity!r}, only for {list(REGISTRY)}")
    return REGISTRY[entity]


# The identifier formats, code lists and bounds of the feed contracts.
POLICY_ID = matches("^POL-[0-9]{8}$")
CLAIM_ID = matches("^CLM-[0-9]{8}$")
PREMIUM_ID = matches("^PRM-[0-9]{8}$")
RI_RECORD_ID = matches("^RI-[0-9]{8}$")
REINSURER_ID = matches("^RNS-[A-Z0-9]{6}$")
CURRENCY = matches("^[A-Z]{3}$")
COVERAGE_TYPES = one_of("LIFE", "HEALTH", "AUTO", "PROPERTY", "LIABILITY")
POLICY_STATUSES = one_of("ACTIVE", "CANCELLED", "EXPIRED", "PENDING")
CLAIM_TYPES = one_of("ACCIDENT", "THEFT", "FIRE", "FLOOD", "LIABILITY", "MEDICAL", "DEATH", "OTHER")
CLAIM_STATUSES = one_of("OPEN", "IN_REVIEW", "APPROVED", "PARTIALLY_APPROVED", "DENIED", "CLOSED", "APPEALED")
PAYMENT_METHODS = one_of("BANK_TRANSFER", "CREDIT_CARD", "DEBIT_CARD", "CHEQUE", "DIRECT_DEBIT", "OTHER")
PREMIUM_STATUSES = one_of("PENDING", "PAID", "OVERDUE", "PARTIALLY_PAID", "WAIVED", "REFUNDED")
TREATY_TYPES = one_of("QUOTA_SHARE", "SURPLUS", "EXCESS_OF_LOSS", "STOP_LOSS", "FACULTATIVE")
RI_STATUSES = one_of("ACTIVE", "SETTLED", "DISPUTED", "CANCELLED", "PENDING_RECOVERY")
PREMIUM_LIMIT = below(10_000_000)
CLAIM_LIMIT = below(50_000_000)

DIR_ID = Field("dir_id", nullable=True, required=False)

POLICIES = register(
    EntitySpec(
        name="policies",
        key="policy_id",
        fields=(
            Field("policy_id", rules=(POLICY_ID,)),
            Field("insured_name"),
            Field("policy_start_date", "date", rules=(since("2000-01-01"),)),
            Field("policy_end_date", "date"),
            Field("premium_amount", "double", rules=(above(0), PREMIUM_LIMIT)),
            Field("coverage_type", rules=(COVERAGE_TYPES,)),
            Field("risk_score", "double", nullable=True, rules=(in_range(0.0, 1.0),)),
            Field("broker_id", nullable=True),
            Field("status", rules=(POLICY_STATUSES,)),
            DIR_ID,
        ),
        upper=("policy_id", "coverage_type", "status"),
        clipped={"risk_score": (0.0, 1.0)},
        derived={
            "policy_duration_days": "datediff(policy_end_date, policy_start_date)",
            "annual_premium_eur": "premium_amount",
        },
    )
)

CLAIMS = register(
    EntitySpec(
        name="claims",
        key="claim_id",
        fields=(
            Field("claim_id", rules=(CLAIM_ID,)),
            Field("policy_id", rules=(POLICY_ID,)),
            Field("claimant_name"),
            Field("adjuster_id", nullable=True),
            Field("incident_date", "date", rules=(since("2020-01-01"),)),
            Field("reported_date", "date", rules=(since("2020-01-01"),)),
            Field("claim_type", rules=(CLAIM_TYPES,)),
            Field("status", rules=(CLAIM_STATUSES,)),
            Field("claimed_amount", "double", rules=(at_least(0), CLAIM_LIMIT)),
            Field("approved_amount", "double", nullable=True, rules=(at_least(0), CLAIM_LIMIT)),
            Field("deductible_applied", "double", nullable=True, rules=(at_least(0),)),
            Field("fraud_flag", "bool", nullable=True),
            DIR_ID,
        ),
        upper=("claim_id", "policy_id", "claim_type", "status"),
        derived={
            "days_to_report": cells.floor_at_zero("datediff(reported_date, incident_date)"),
            "approval_rate": cells.bounded_ratio("approved_amount", "claimed_amount"),
        },
    )
)

PREMIUMS = register(
    EntitySpec(
        name="premiums",
        key="premium_id",
        fields=(
            Field("premium_id", rules=(PREMIUM_ID,)),
            Field("policy_id", rules=(POLICY_ID,)),
            Field("payment_date", "date", nullable=True, rules=(since("2000-01-01"),)),
            Field("due_date", "date", rules=(since("2000-01-01"),)),
            Field("amount_due", "double", rules=(above(0), PREMIUM_LIMIT)),
            Field("amount_paid", "double", nullable=True, rules=(at_least(0), PREMIUM_LIMIT)),
            Field("late_fee", "double", nullable=True, rules=(at_least(0),)),
            Field("payment_method", nullable=True, rules=(PAYMENT_METHODS,)),
            Field("currency", rules=(CURRENCY,)),
            Field("instalment_number", "int", rules=(at_least(1), at_most(12))),
            Field("instalment_total", "int", rules=(at_least(1), at_most(12))),
            Field("status", rules=(PREMIUM_STATUSES,)),
            DIR_ID,
        ),
        upper=("premium_id", "policy_id", "currency", "status"),
        derived={
            "payment_variance": "amount_paid - amount_due",
            "days_overdue": "CASE WHEN status = 'OVERDUE' THEN datediff({as_of}, due_date) END",
        },
    )
)

REINSURANCE = register(
    EntitySpec(
        name="reinsurance",
        key="ri_record_id",
        fields=(
            Field("ri_record_id", rules=(RI_RECORD_ID,)),
            Field("policy_id", rules=(POLICY_ID,)),
            Field("claim_id", nullable=True, rules=(CLAIM_ID,)),
            Field("reinsurer_id", rules=(REINSURER_ID,)),
            Field("reinsurer_name"),
            Field("treaty_id"),
            Field("treaty_type", rules=(TREATY_TYPES,)),
            Field("cession_date", "date", rules=(since("2000-01-01"),)),
            Field("cession_percentage", "double", rules=(in_range(0, 100),)),
            Field("ceded_premium", "double", rules=(at_least(0),)),
            Field("ceded_liability", "double", rules=(at_least(0),)),
            Field("recovered_amount", "double", nullable=True, rules=(at_least(0),)),
            Field("currency", rules=(CURRENCY,)),
            Field("status", rules=(RI_STATUSES,)),
            DIR_ID,
        ),
        upper=("ri_record_id", "policy_id", "currency", "treaty_type", "status"),
        clipped={"cession_percentage": (0.0, 100.0)},
        derived={
            "retained_liability": cells.retained("ceded_liability", "cession_percentage"),
            "recovery_ratio": cells.bounded_ratio("recovered_amount", "ceded_liability"),
        },
    )
)
