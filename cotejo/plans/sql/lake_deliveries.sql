-- Units and amount per month, institution and product over three lake tables.
-- Only the newest freeze of the frozen table counts; each table is cut to its own newest years.
-- The rows of all tables are stacked and summed once.
with newest as (
    select max(ref_frz_dt) as freeze, max(year(cast(date as date))) as newest_year
    from {frozen_deliveries}
),
stacked as (
    select date as month_date,
           'Normales' as institucion,
           product_code as product_id,
           cast(sales_units as decimal(28, 6)) as units,
           bround(cast(sales_values as decimal(28, 6)), 2) as amount
    from {frozen_deliveries}
    where ref_frz_dt = (select freeze from newest)
      and year(cast(date as date)) >= (select newest_year from newest) - :regular_years
    union all
    select concat_ws('-', annual, lpad(mes, 2, '0'), '01'), 'IMSS', clave_cbycm,
           cast(piezas as decimal(28, 6)), cast(importe as decimal(28, 6))
    from {first_programme}
    where annual >= (select max(annual) from {first_programme}) - :programme_years
    union all
    select concat_ws('-', annual, lpad(mes, 2, '0'), '01'), 'ISSSTE', clave_cbycm,
           cast(piezas as decimal(28, 6)), cast(importe as decimal(28, 6))
    from {second_programme}
    where annual >= (select max(annual) from {second_programme}) - :programme_years
)
select month_date, institucion, product_id, sum(units) as units, sum(amount) as amount
from stacked
group by month_date, institucion, product_id
