"""Declared schemas of the six logical tables, their domains and layer names."""

from pyspark.sql import types as T


def _schema(**columns):
    """StructType from name=type keywords; every column is nullable."""
    return T.StructType([T.StructField(n, t, True) for n, t in columns.items()])


_L, _I, _S = T.LongType(), T.IntegerType(), T.StringType()
_TS, _D, _F = T.TimestampNTZType(), T.DateType(), T.DoubleType()

SCHEMAS = {
    "users": _schema(
        user_id=_L, email=_S, age=_I, city=_S, channel=_S, registered_at=_TS, is_active=_I
    ),
    "courses": _schema(
        course_id=_L, title=_S, subject=_S, level=_S, course_type=_S, price_rub=_L,
        duration_weeks=_F, created_at=_TS, is_published=_I,
    ),
    "enrollments": _schema(
        enrollment_id=_L, user_id=_L, course_id=_L, enrolled_at=_TS, status=_S, progress_pct=_I
    ),
    "payments": _schema(
        payment_id=_L, user_id=_L, course_id=_L, enrollment_id=_L, paid_at=_TS, amount_rub=_L,
        base_price=_L, discount_pct=_I, status=_S, payment_method=_S,
    ),
    "payment_attempts": _schema(
        attempt_id=_L, user_id=_L, course_id=_L, attempted_at=_TS, result=_S,
        failure_reason=_S, payment_method=_S,
    ),
    "ad_costs": _schema(date=_D, channel=_S, impressions=_L, clicks=_L, spend_rub=_L),
}

TABLES = list(SCHEMAS)

# The business domains every rule and mart is defined over.
CHANNELS = ["organic", "vk_ads", "yandex_direct", "telegram", "referral", "email"]
PAID_CHANNELS = ["vk_ads", "yandex_direct", "telegram"]
LEVELS = ["Базовый", "Продвинутый", "Эксперт"]
COURSE, INTENSIVE, SUBSCRIPTION = "Курс", "Интенсив", "Подписка"
ENROLLMENT_STATUSES = ["active", "completed", "dropped", "paused"]
PAYMENT_STATUSES = ["success", "refunded", "failed"]
ATTEMPT_RESULTS = ["success", "failed", "abandoned"]
LAYERS = ["raw", "staging", "marts"]
STAGED_PREFIX = "stg_"
