import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

# The 20-row sample landing file of the reference pipeline.
SAMPLE_CSV = """customer_id,gender,senior_citizen,partner,dependents,tenure_months,phone_service,internet_service,contract_type,paperless_billing,payment_method,monthly_charges,total_charges,churn
C0001,Female,0,Yes,No,12,Yes,Fiber optic,Month-to-month,Yes,Electronic check,75.50,906.00,No
C0002,Male,0,No,No,1,No,DSL,Month-to-month,Yes,Mailed check,29.85,29.85,Yes
C0003,Female,1,Yes,Yes,72,Yes,Fiber optic,Two year,No,Bank transfer,103.20,7430.40,No
C0004,Male,0,Yes,Yes,45,Yes,Fiber optic,One year,Yes,Credit card,89.10,4009.50,No
C0005,Male,0,No,No,2,Yes,Fiber optic,Month-to-month,Yes,Electronic check,70.70,141.40,Yes
C0006,Female,1,No,No,8,Yes,DSL,Month-to-month,Yes,Electronic check,99.65,820.50,Yes
C0007,Male,0,Yes,Yes,28,Yes,Fiber optic,One year,Yes,Credit card,104.80,3046.05,No
C0008,Female,0,No,No,62,Yes,Fiber optic,Two year,No,Bank transfer,90.05,5681.10,No
C0009,Male,1,Yes,No,3,Yes,Fiber optic,Month-to-month,Yes,Electronic check,95.00,267.40,Yes
C0010,Female,0,No,No,18,Yes,DSL,Month-to-month,No,Mailed check,55.40,1015.75,No
C0011,Male,0,Yes,Yes,49,Yes,Fiber optic,One year,Yes,Credit card,99.45,4862.35,No
C0012,Female,0,No,No,5,No,DSL,Month-to-month,Yes,Electronic check,45.20,231.85,Yes
C0013,Male,1,Yes,No,67,Yes,Fiber optic,Two year,No,Bank transfer,108.15,7144.75,No
C0014,Female,0,Yes,Yes,36,Yes,Fiber optic,One year,Yes,Credit card,93.80,3415.10,No
C0015,Male,0,No,No,1,Yes,DSL,Month-to-month,Yes,Electronic check,49.30,49.30,Yes
C0016,Female,0,Yes,Yes,55,Yes,Fiber optic,Two year,No,Bank transfer,99.95,5535.60,No
C0017,Male,1,No,No,4,Yes,Fiber optic,Month-to-month,Yes,Electronic check,89.50,361.40,Yes
C0018,Female,0,Yes,No,21,Yes,DSL,One year,Yes,Credit card,64.85,1379.95,No
C0019,Male,0,No,No,10,Yes,Fiber optic,Month-to-month,Yes,Electronic check,82.60,820.40,Yes
C0020,Female,0,Yes,Yes,71,Yes,Fiber optic,Two year,No,Bank transfer,113.55,8068.95,No
"""

# A dirty landing file: short row, padded id with bad numbers, empty id, surplus token.
DIRTY_CSV = """customer_id,gender,senior_citizen,partner,dependents,tenure_months,phone_service,internet_service,contract_type,paperless_billing,payment_method,monthly_charges,total_charges,churn
C0001,Female,0,Yes
 C0021 ,Male,x,Yes,No,0,Yes,DSL,One year,No,Credit card,abc,,maybe
,Male,0,No,No,1,No,DSL,Month-to-month,Yes,Mailed check,29.85,29.85,Yes
C0022,Male,0,No,No,1,No,DSL,Month-to-month,Yes,Mailed check,29.85,29.85,Yes,EXTRA
"""

SMALL_SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from tessera.session import build_session

    s = build_session(master="local[4]", shuffle_partitions=4)
    yield s
    s.stop()


@pytest.fixture()
def tmpdir_fresh():
    return tempfile.mkdtemp(prefix="tessera-test-", dir="/tmp")


def write_text(path: str, name: str, text: str) -> str:
    os.makedirs(path, exist_ok=True)
    p = os.path.join(path, name)
    with open(p, "w") as f:
        f.write(text)
    return p
