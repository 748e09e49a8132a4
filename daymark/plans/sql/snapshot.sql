SELECT MATCH_ID, PCT_ACTIVES AS ACTIVEPCT
FROM IDENTIFIER(:snapshot)
WHERE DAYS_ON_PLATFORM = :day
