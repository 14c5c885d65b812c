"""Hand-made input tables with known defects, and the results worked out by hand."""

AS_OF = "2025-07-15 00:00:00"

CSV = {
    "users": """
user_id,email,age,city,channel,registered_at,is_active
1,a@x,16,M,organic,2024-01-05 10:00:00,1
2,b@x,17,M,vk_ads,2024-01-20 09:00:00,1
3,c@x,18,K,vk_ads,2024-02-10 12:00:00,1
4,d@x,20,K,telegram,2024-02-15 08:00:00,0
5,a@x,21,M,yandex_direct,2024-03-01 10:00:00,1
6,e@x,22,M,,2024-03-03 10:00:00,1
7,f@x,23,M,vk_ads,2025-09-01 10:00:00,1
8,f@x,23,M,telegram,2024-03-10 10:00:00,1
9,,24,S,organic,2024-03-11 10:00:00,1
10,,25,S,organic,2024-03-12 10:00:00,1
""",
    "courses": """
course_id,title,subject,level,course_type,price_rub,duration_weeks,created_at,is_published
1,t1,Математика,Базовый,Курс,3000,8.0,2023-12-01 00:00:00,1
2,t2,Физика,Эксперт,Подписка,1000,,2023-12-01 00:00:00,1
3,t3,Химия,Базовый,Интенсив,4000,6.0,2023-12-01 00:00:00,1
4,t4,Математика,Базовый,Курс,0,12.0,2023-12-01 00:00:00,1
5,t5,История,Базовый,Курс,2500,8.0,2023-12-01 00:00:00,0
""",
    "enrollments": """
enrollment_id,user_id,course_id,enrolled_at,status,progress_pct
1,1,1,2024-01-06 10:00:00,completed,100
2,1,2,2024-02-07 10:00:00,active,40
3,2,1,2024-01-25 10:00:00,dropped,30
4,2,3,2024-03-02 10:00:00,paused,50
5,3,2,2024-02-12 10:00:00,active,100
6,4,1,2024-02-14 10:00:00,active,10
7,4,4,2024-02-20 10:00:00,archived,5
8,6,5,2024-03-05 10:00:00,active,20
9,6,99,2024-03-06 10:00:00,active,20
10,5,1,2024-03-04 10:00:00,completed,100
11,77,1,2024-03-04 10:00:00,active,15
12,3,1,2024-02-20 10:00:00,completed,100
13,9,3,2024-03-15 10:00:00,,100
""",
    "payments": """
payment_id,user_id,course_id,enrollment_id,paid_at,amount_rub,base_price,discount_pct,status,payment_method
1,1,1,1,2024-01-06 11:00:00,2700,3000,10,success,card
2,1,2,2,2024-02-07 11:00:00,1000,1000,0,success,card
3,1,2,2,2024-03-08 11:00:00,1000,1000,0,success,card
4,2,1,3,2024-01-26 11:00:00,3000,3000,0,success,sbp
5,2,3,4,2024-03-02 11:00:00,-4000,4000,0,success,card
6,3,2,5,2024-02-12 11:00:00,0,1000,0,success,card
7,3,1,12,2024-02-21 11:00:00,2400,3000,20,success,card
8,4,1,6,2024-02-14 11:00:00,3000,3000,0,success,card
9,4,4,7,2024-02-21 11:00:00,500,0,0,success,wallet
10,6,1,999,2024-03-06 11:00:00,3000,3000,0,success,card
11,1,1,1,2024-01-20 11:00:00,0,3000,0,refunded,card
12,3,2,5,2024-03-12 11:00:00,1000,1000,0,failed,card
13,5,1,10,2024-03-04 11:00:00,3000,3000,0,success,card
14,2,3,4,2024-03-01 11:00:00,4000,4000,0,refunded,card
""",
    "payment_attempts": """
attempt_id,user_id,course_id,attempted_at,result,failure_reason,payment_method
1,1,1,2024-01-06 11:00:00,success,,card
2,1,2,2024-02-07 11:00:00,success,,card
3,2,1,2024-01-26 11:00:00,success,,sbp
4,2,3,2024-03-02 11:00:00,success,,card
5,3,1,2024-02-21 11:00:00,success,,card
6,6,1,2024-03-06 11:00:00,success,,card
7,900,1,2024-03-06 12:00:00,success,,card
8,2,3,2024-03-01 12:00:00,failed,timeout,card
9,1,2,2024-02-07 09:00:00,abandoned,user_cancelled,card
10,3,2,2024-02-12 09:00:00,abandoned,user_cancelled,card
11,4,1,2024-02-20 09:00:00,failed,card_declined,card
12,4,1,2024-02-20 09:05:00,unknown,timeout,card
13,9,3,2024-03-15 11:00:00,,timeout,card
14,6,2,2024-03-07 11:00:00,success,,card
""",
    "ad_costs": """
date,channel,impressions,clicks,spend_rub
2024-01-10,vk_ads,1000,20,500
2024-01-11,vk_ads,1000,10,300
2024-02-10,vk_ads,2000,0,400
2024-02-10,telegram,500,20,200
2024-02-11,telegram,500,10,0
2025-08-01,vk_ads,100,1,50
2024-01-12,organic,100,1,50
2024-03-01,telegram,0,0,0
""",
}

RAW_COUNTS = {
    "A1": 6, "A2": 1, "A3": 1, "A4": 1, "A5": 1, "A6": 1, "A7": 2, "A8": 2, "A9": 1, "A10": 1,
    "A11": 1, "A12": 1, "A13": 1, "A14": 1, "A15": 1, "A16": 2, "A17": 2, "A18": 1, "A19": 1, "A20": 1,
}
STAGED_COUNTS = dict.fromkeys(RAW_COUNTS, 0) | {"A3": 1, "A4": 1, "A7": 2, "A8": 2, "A13": 1}
RULE_COUNTS = {"X1": 1, "X2": 0, "X3": 0, "X4": 1}

STAGED_KEYS = {
    "users": [1, 2, 3, 4, 6, 9],
    "courses": [1, 2, 3, 4],
    "enrollments": [1, 2, 3, 4, 5, 7, 12, 13],
    "payments": [1, 2, 3, 4, 7, 9, 12, 14],
    "payment_attempts": [1, 2, 3, 4, 5, 8, 9, 10, 11],
}

N = None
MART_REVENUE = [
    ("2024-01-01", 2, 2, 5700, 2850, 2850, 0, 50.0, 5700, 0, 0, N, N, 5700),
    ("2024-02-01", 3, 3, 3900, 1300, 1300, 1000, 33.3, 2900, 0, 1000, 5700, -31.6, 9600),
    ("2024-03-01", 1, 1, 1000, 1000, 1000, 1000, 0.0, 0, 0, 1000, 3900, -74.4, 10600),
]
MART_ADS = [
    ("2024-01-01", "vk_ads", 800, 2000, 30, 1, 1, 3000, 1.5, 27, 400, 800, 3.75),
    ("2024-02-01", "telegram", 200, 500, 20, 1, 1, 500, 4.0, 10, 400, 200, 2.5),
    ("2024-02-01", "vk_ads", 400, 2000, 0, 1, 1, 2400, 0.0, N, 200, 400, 6.0),
    ("2024-03-01", "telegram", 0, 0, 0, 0, 0, 0, N, N, N, N, N),
]
MART_ACTIVITY = [
    ("2024-01-01", 0, 2, 2, 100.0),
    ("2024-01-01", 1, 2, 1, 50.0),
    ("2024-01-01", 2, 2, 1, 50.0),
    ("2024-02-01", 0, 2, 2, 100.0),
    ("2024-03-01", 0, 1, 1, 100.0),
]
MART_COMPLETION = [
    ("Математика", "Базовый", "Курс", 4, 2, 0, 1, 50.0, 25.0, N),
    ("Физика", "Эксперт", "Подписка", 2, 0, 2, 0, 0.0, 0.0, 70.0),
    ("Химия", "Базовый", "Интенсив", 2, 0, 0, 0, 0.0, 0.0, N),
]
MART_CONVERSION = [
    ("2024-01-01", 2, 2, 2, 1, 100.0, 100.0, 50.0, 100.0, 6, 1, 16.7),
    ("2024-02-01", 2, 2, 2, 1, 100.0, 100.0, 50.0, 100.0, 3, 1, 33.3),
    ("2024-03-01", 2, 1, 0, 0, 50.0, 0.0, N, 0.0, 0, 0, N),
]
