-- Volume, mean delays, cancellations and mean distance, per carrier.
SELECT carrier,
       count(*)               AS flight_count,
       avg(dep_delay_minutes) AS avg_dep_delay_minutes,
       avg(arr_delay_minutes) AS avg_arr_delay_minutes,
       sum(cancelled_flag)    AS cancelled_count,
       avg(distance_miles)    AS avg_distance_miles,
       coalesce(cast(:at AS timestamp), current_timestamp()) AS load_ts
FROM identifier(:silver || '.aviation_flights')
GROUP BY carrier
