import decimal
import hashlib


def norm(v):
    if v is None:
        return "NULL"
    if isinstance(v, float):
        return repr(round(v, 6))
    if isinstance(v, decimal.Decimal):
        return str(v.normalize()) if v == v.to_integral() else str(v)
    if hasattr(v, "isoformat"):
        return v.isoformat()
    return str(v)


def digest(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    lines = sorted("|".join(norm(r[i]) for i in order) for r in rows)
    return hashlib.sha1("\n".join(lines).encode()).hexdigest()


def plan_text(df, mode="formatted"):
    return df._jdf.queryExecution().executedPlan().toString() if mode == "exec" else \
        df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), mode)
