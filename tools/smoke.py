"""Run every registered query once and print rows / schema / seconds."""
import sys, time
sys.path.insert(0, ".")
from obsengine.session import local_session
from obsengine.plans.queries import REGISTRY

sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.001"
only = sys.argv[2].split(",") if len(sys.argv) > 2 else None
spark = local_session(8)
for name, fn in REGISTRY.items():
    if only and name not in only:
        continue
    t = time.time()
    try:
        df = fn(spark, sf)
        n = df.count()
        print(f"OK   {name:28s} rows={n:8d} {time.time()-t:6.2f}s {df.schema.simpleString()[:150]}", flush=True)
    except Exception as e:
        print(f"FAIL {name:28s} {type(e).__name__}: {str(e)[:400]}", flush=True)
