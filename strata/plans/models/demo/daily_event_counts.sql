-- Events per day.
SELECT event_date,
       count(*) AS event_count,
       coalesce(cast(:at AS timestamp), current_timestamp()) AS load_ts
FROM identifier(:silver || '.demo_sample_events')
GROUP BY event_date
