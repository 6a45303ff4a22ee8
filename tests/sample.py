"""The reference's sample data (FIXTURES.md section 2), as CSV text.

Fixed values: these rows must equal the reference's sample for the expected
results of FIXTURES.md section 3 to hold.
"""

CUSTOMERS_HEADER = "CustomerID,CustomerName,Country,RiskCategory,KYCStatus,Occupation,EffectiveDate"
CUSTOMER_ROWS = {
    "c1": "C001,John  Doe,Uganda,Low,Verified,Trader,01/01/2025",
    "c2": "C001,John Doe ,uganda,Medium,Verified,Trader,Feb 15 2025",
    "c3": "C002,Mary@N,Kenya,High,Pending,N/A,2025-01-10",
    "c4": "C003,Peter O,Uganda ,Low,Verified,Farmer,01/20/2025",
    "c5": "C004,Alice K,Tanzania,Medium,Verified,Teacher,Mar 01 2025",
    "c6": "C005,Brian K,Uganda,High,Pending,Engineer,02/02/2025",
    "c7": "C005,Brian K ,uganda,High,Verified,Engineer,03/05/2025",
    "c8": "C006,N/A,Rwanda,Low,Verified,N/A,01/25/2025",
}

ACCOUNTS = """AccountID,CustomerID,AccountType,Currency,OpenDate
A001,C001,Savings,UGX,01/01/2024
A002,C002,Current,usd,Feb 10 2024
A003,C003,Mobile,UGX ,2024-03-05
A004,C004,Savings,UGX,03/15/2024
A005,C005,Mobile,UGX,Apr 01 2024
A006,C006,Current,USD,05/01/2024
"""

TRANSACTIONS = """TransactionID,CustomerID,AccountID,TransactionDate,Amount,TransactionType,Channel,DestinationCountry,IsFraud,IsLaundered,RiskScore
T001,C001,A001,01/05/2025,"1,200",Deposit,Branch,Uganda,0,0,20
T002,C001,A001,Jan 20 2025,950,Transfer,Mobile,Kenya,1,1,65
T003,C002,A002,02/01/2025,5000,Transfer,Mobile,Nigeria,1,1,85
T004,C003,A003,02/10/2025,300,Withdrawal,ATM,Uganda,0,0,15
T005,C004,A004,Mar 05 2025,"2,500",Transfer,Mobile,Tanzania,1,0,55
T006,C005,A005,03/10/2025,7000,Transfer,Mobile,UAE,1,1,90
T007,C005,A005,03/10/2025,7000,Transfer,Mobile,UAE,1,1,90
T008,C006,A006,01/15/2025,400,Deposit,Branch,Rwanda,0,0,10
T009,C002,A002,Feb 20 2025,4800,Transfer,Mobile,Nigeria,1,1,88
T010,C001,A001,03/15/2025,"1,100",Transfer,Mobile,Kenya,1,0,60
T011,C003,A003,03/18/2025,350,Withdrawal,ATM,Uganda ,0,0,18
T012,C004,A004,01/25/2025,"2,000",Deposit,Branch,Tanzania,0,0,25
T013,C005,A005,02/28/2025,6800,Transfer,Mobile,UAE,1,1,92
T014,C002,A002,03/02/2025,5100,Transfer,Mobile,Nigeria,1,1,87
T015,C001,A001,02/14/2025,999,Transfer,Mobile,Kenya,1,1,70
"""


def customers_csv(*row_ids: str) -> str:
    return CUSTOMERS_HEADER + "\n" + "\n".join(CUSTOMER_ROWS[r] for r in row_ids) + "\n"
